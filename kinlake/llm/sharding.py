"""Two-pass external shuffle of documents into shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a bucket holds on average; a bucket is shuffled in memory.
BUCKET_BYTES = 8_000_000
#: Bytes of text that one task of the second pass reads on average.
TASK_BYTES = 64_000_000
#: A shard is scattered over this many buckets at least.
LEAST_BUCKETS = 4


def shard_of(doc_id: Column, shards: int, seed: int) -> Column:
    """The shard with the highest seeded hash of (shard, doc_id): one more shard takes rows only into itself."""
    score = lambda s: F.struct(F.xxhash64(F.lit(seed), s, doc_id).alias("h"), s.alias("s"))
    return F.greatest(*[score(F.lit(s)) for s in range(shards)])["s"] if shards > 1 else F.lit(0)


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, text, shard, grown_shard, bucket and slot of every document, in two passes.

    First pass: a seeded hash of doc_id puts a row into its shard (doc_id and the number of shards decide), and a
    seeded hash of doc_id and text scatters the shard's rows over memory-sized buckets, whose number follows the
    table's bytes. Second pass: each bucket is put in a fixed order and gets a seeded Fisher-Yates shuffle; slot is
    the row's place in its shard, gapless from 0. grown_shard: the shard with one shard more. A null text counts as
    empty, a null doc_id as a key of its own. Rows that repeat a doc_id share its shard; only rows that also repeat
    the text share a bucket. A text longer than a bucket's bytes stays whole, in one bucket. An empty table gives an empty
    result; other columns are not looked at.
    """
    work = docs.select("doc_id", "text")
    total = work.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // (shards * bucket_bytes)))
    work = work.withColumns({"shard": shard_of(F.col("doc_id"), shards, seed), "bucket": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", F.coalesce("text", F.lit(""))), F.lit(buckets)).cast("int")})
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def fisher_yates(key: tuple, rows: pa.Table, offset: pa.Table) -> pa.Table:
        shard, bucket = (k.as_py() for k in key)
        rows = rows.take(np.lexsort((rows["order"].to_numpy(), rows["doc_id"].fill_null(-1).to_numpy())))
        place = np.arange(rows.num_rows)
        np.random.default_rng([seed, shard, bucket]).shuffle(place)  # numpy's shuffle is Fisher-Yates
        return rows.drop_columns(["order"]).take(place).append_column("slot", pa.array(np.arange(rows.num_rows) + offset["offset"][0].as_py(), pa.int64()))

    fields = [f for f in work.schema if f.name in ("doc_id", "text", "shard", "bucket")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("slot", T.LongType())])
    # as many tasks as the bytes ask for, whatever the session's number of partitions
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards * buckets, -(-total // TASK_BYTES)))
    shuffled = work.withColumn("order", F.xxhash64("text")).repartition(tasks, "shard", "bucket").groupBy("shard", "bucket")
    # a bucket's offset, one row, goes to the bucket's task, so the texts are shuffled once and nothing is broadcast
    out = shuffled.cogroup(offsets.groupBy("shard", "bucket")).applyInArrow(fisher_yates, schema)
    return out.select("doc_id", "text", "shard", shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard"), "bucket", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, in it one folder a bucket with its rows by rising slot; a shard's buckets in order hold its slots in
    order. Nulls and repeated rows are written as they are; an empty table writes no folder."""
    # sorted by the folders first, which is the order that the writer asks for, so it does not sort again and keeps the slots
    sharded.repartition("shard", "bucket").sortWithinPartitions("shard", "bucket", "slot").write.partitionBy("shard", "bucket").parquet(path)
