"""Pairs of chunks are spread over tasks."""

from kinlake.operators import sets


def test_pairs_of_a_short_list_are_the_work_of_several_tasks(spark):
    chunks = spark.range(100).selectExpr("concat('s', id) as s", "concat('c', id % 20) as chunk")
    pairs = sets.chunk_pairs(chunks)
    names = [f"c{k}" for k in range(20)]
    assert sorted(map(tuple, pairs.collect())) == sorted((a, b) for a in names for b in names if a <= b)
    assert pairs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
