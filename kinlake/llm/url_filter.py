"""URL filter: glob rules packed into Shift-And masks that run side by side over every canonical URL."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_chunks, tidy

#: (verdict, rule): a rule is a host, which also stands for its subdomains, and the start of a path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: The verdict on a URL that no rule fits.
DEFAULT = "allow"


class ShiftAnd:
    """Bit-parallel automaton for anchored globs: `*` stands for bytes other than '/', `**` for any bytes.

    Every pattern takes one bit for its start and one for each literal byte; the bits of all patterns lie side by
    side in 64-bit words. For a byte c, LIT[c] marks states entered by c and LOOP[c] states that a star lets c stay
    in. A step over all URLs of a batch is: state = ((state << 1) & LIT[c]) | (state & LOOP[c]).
    """

    def __init__(self, globs: Sequence[str]):
        starts, ends, lit, loop, pos = [], [], [], [], 0
        for glob in globs:
            starts.append(pos)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    loop.append((pos, True))
                    i += 2
                elif raw[i : i + 1] == b"*":
                    loop.append((pos, False))
                    i += 1
                else:
                    pos += 1
                    lit.append((raw[i], pos))
                    i += 1
            ends.append(pos)
            pos += 1
        self.words = max(1, -(-pos // 64))
        self.LIT, self.LOOP = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for c, p in lit:
            self.LIT[c, p // 64] |= np.uint64(1 << p % 64)
        for p, every in loop:
            self.LOOP[:, p // 64] |= np.uint64(1 << p % 64)
            if not every:
                self.LOOP[ord("/"), p // 64] &= ~np.uint64(1 << p % 64)
        for p in starts:
            self.start[p // 64] |= np.uint64(1 << p % 64)
        self.ends = ends

    def run(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row for each text, a column for each glob: whether it fits the whole text."""
        size = np.array([len(x) for x in texts], np.int64)
        order = np.argsort(-size, kind="stable")
        size, flat = size[order], np.frombuffer(b"".join(texts[i] for i in order) + b"\0", np.uint8)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        state = np.tile(self.start, (len(texts), 1))
        live = len(texts)
        for k in range(int(size[0]) if len(texts) else 0):
            live = int(np.searchsorted(-size, -k, "left"))  # texts longer than k come first
            c, s = flat[begin[:live] + k], state[:live]
            up = s << np.uint64(1)
            up[:, 1:] |= s[:, :-1] >> np.uint64(63)
            state[:live] = (up & self.LIT[c]) | (s & self.LOOP[c])
        out = np.zeros((len(texts), len(self.ends)), bool)
        for j, p in enumerate(self.ends):
            out[order, j] = (state[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1) != 0
        return out


def _split(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)"))
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every page.

    Host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path: then up to '?', '#' or the
    end. A null url, or one without '://', has an empty host and path, so no rule fits it. A rule fits its host and
    all subdomains where the path starts with the rule's path. The longest fitting rule wins (of equally long ones
    the first given); where none fits, rule is null and the verdict is `default`. Repeated rows are judged each by
    itself, an empty table gives an empty result, other columns are not looked at. Urls of any length are read whole.
    """
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), i))
    globs = []
    for i in ranked:
        host, slash, path = rules[i][1].partition("/")
        globs.append(f"*.{host}{slash}{path}**")
    machine = ShiftAnd(globs)

    @F.arrow_udf("int")
    @tidy
    def first_fit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for canonical in batches:
            fits = [machine.run(texts) for _, _, texts in text_chunks(canonical)]
            yield pa.array(np.concatenate([np.where(x.any(axis=1), x.argmax(axis=1), -1) for x in fits] or [np.zeros(0, int)]), pa.int32())

    host, path = _split(F.col("url"))
    out = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    out = out.withColumn("fit", first_fit(F.concat(F.lit("."), "host", "path")))
    pick = lambda k: F.coalesce(*[F.when(F.col("fit") == j, F.lit(rules[i][k])) for j, i in enumerate(ranked)], F.lit(None).cast("string"))
    return out.select("page_id", "url", "host", "path", pick(1).alias("rule"), F.coalesce(pick(0), F.lit(default)).alias("verdict"))
