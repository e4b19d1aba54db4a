"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, gathered, kept, text_chunks, tidy

VOCABULARY = "piece_bpe_32k.model"
#: What stands before every pre-token.
MARK = "▁"
#: Nodes of a worker's trie; beyond it, it starts afresh.
NODES = 1_000_000
#: Letters of a pre-token up to which it goes into the trie; a longer one, which few others share, is worked out by itself.
LONG = 200


def load_pieces(file: str) -> dict[str, float]:
    """Pieces and log probabilities. The file ranks its pieces; they get Zipf's law over their rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(pieces, key=lambda p: -model.get_score(model.piece_to_id(p)))
    total = math.log(sum(1 / (r + 2) for r in range(len(ranked))))
    return {p: -math.log(r + 2) - total for r, p in enumerate(ranked)}


class PretokenTrie:
    """Pre-tokens letter by letter. A node holds the forward score of its prefix (the best sum of log probabilities
    over all segmentations) and the number of tokens of that best one, so a prefix that many pre-tokens share is
    worked out once; the count at a pre-token's last node is its token count. A letter that no piece holds is spelled
    in bytes, each at the least log probability less one. Of equal scores the segmentation with fewer tokens wins."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.byte = min(pieces.values(), default=0.0) - 1
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]

    def count_long(self, word: str) -> int:
        """The same by a forward pass that keeps the scores of the last letters only, as many as the longest piece has."""
        scores = [(0.0, 0)]  # of the prefixes that end at i + 1 - len(scores) to i
        for i, c in enumerate(word):
            size = len(c.encode("utf-8", "surrogatepass"))
            best = (scores[-1][0] + size * self.byte, scores[-1][1] - size)
            for k in range(1, len(scores) + 1):
                if (p := self.pieces.get(word[i + 1 - k : i + 1])) is not None:
                    best = max(best, (scores[-k][0] + p, scores[-k][1] - 1))
            scores.append(best)
            if len(scores) > self.longest:
                del scores[0]
        return -scores[-1][1]

    def count(self, word: str) -> int:
        if len(word) > LONG:
            return self.count_long(word)
        node, path, get = 0, [0], self.child.get
        for i, c in enumerate(word):
            if (to := get((node, c))) is None:
                size = len(c.encode("utf-8", "surrogatepass"))
                best = (self.score[node] + size * self.byte, -self.tokens[node] - size)
                for k in range(max(0, i + 1 - self.longest), i + 1):
                    if (p := self.pieces.get(word[k : i + 1])) is not None:
                        best = max(best, (self.score[path[k]] + p, -self.tokens[path[k]] - 1))
                to = self.child[node, c] = len(self.score)
                self.score.append(best[0])
                self.tokens.append(-best[1])
            node = to
            path.append(node)
        return self.tokens[node]


def _count(file: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept(__name__)
        pieces = held[file].pieces if file in held else load_pieces(file)
        for batch in gathered(batches, 6_000_000):
            docs = batch.column(0)
            words, tokens = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            for lo, hi, texts in text_chunks(batch.column(1), 6_000_000):
                if file not in held or len(held[file].score) > NODES:
                    held[file] = PretokenTrie(pieces)
                w = Words(texts)
                _, first, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
                spans = zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)
                distinct = [w.data[a:b].decode() for a, b in spans]
                order = sorted(range(len(distinct)), key=distinct.__getitem__)  # neighbours share prefixes
                counts = np.zeros(len(distinct), np.int64)
                for i in order:
                    counts[i] = held[file].count(MARK + distinct[i])
                words[lo:hi] = w.counts
                if len(inverse):
                    tokens[lo:hi] = np.bincount(w.row, weights=counts[inverse], minlength=hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays([docs, pa.array(words), pa.array(tokens)], names=["doc_id", "n_pretokens", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, file: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens and piece_scores of every document.

    Pre-tokens are the words [^\\x20\\x09-\\x0D]+ of the whole text, each behind MARK; a null or blank text has none. A
    document's count is the sum over its pre-tokens of the tokens in their best segmentation under the vocabulary.
    Pieces are scored by Zipf's law over their rank in the vocabulary file, which has ranks and no probabilities, and nothing is
    fitted to the documents; piece_scores says so in every row. Pre-tokens of over LONG letters are worked out one by one.
    Every chunk of text puts its distinct pre-tokens, sorted, into the worker's trie, so no row is shuffled. Repeated
    rows are counted each by itself; an empty table gives an empty result; other columns are not looked at.
    """
    if file is None:
        import public_tokenizers

        file = public_tokenizers.path(VOCABULARY)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count(file), "doc_id long, n_pretokens long, n_tokens long").withColumn("piece_scores", F.lit("zipf over rank"))
