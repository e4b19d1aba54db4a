"""Trios whose members meet within their family."""

import pytest
from pyspark.sql import functions as F

from kinlake.operators import pedigree, trio
from kinlake.plans import registry, site_queries, sv_queries, trio_queries  # noqa: F401
from kinlake.plans import views as V

DIR = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(str(r) for r in df.collect())


@pytest.mark.parametrize("complete", [True, False])
@pytest.mark.parametrize("kind", [None, "missing"])
def test_members_that_meet_by_family_give_the_same_trios(spark, complete, kind):
    def both():
        trios = pedigree.trio_list(V.view(spark, DIR, "v_ped"))
        return [_rows(trio.trio_entries(V.entries(spark, DIR, families=f), trios, complete=complete)) for f in (False, True)]

    if kind is None:
        plain, by_family = both()
    else:
        with V.variant(kind):
            plain, by_family = both()
    assert plain == by_family and plain


def test_an_entry_meets_the_trios_of_its_family_alone(spark):
    rows = [("chr1", 1, "A", "C", s, f, 0, a2) for f, s, a2 in (("F1", "k", 1), ("F1", "f", 0), ("F1", "m", 0), ("F2", "k", 1), ("F2", "f", 1), ("F2", "m", 0), ("F3", "k", 1))]
    entries = spark.createDataFrame(rows, "contig string, pos int, ref string, alt string, s string, fam_id string, a1 int, a2 int")
    trios = spark.createDataFrame([("F1", "k", "f", "m", True), ("F2", "k", "f", "m", False)], "fam_id string, proband string, father string, mother string, is_female boolean")
    out = trio.trio_entries(entries, trios, fields=trio.CALL).collect()
    assert sorted((r.fam_id, r.is_female, r.kid.a2, r.dad.a2, r.mom.a2) for r in out) == [("F1", True, 1, 0, 0), ("F2", False, 1, 1, 0)]
    dads = trio.trio_entries(entries, trios, fields=trio.CALL, only=F.when(F.col("role") == "dad", F.col("a2") == 1).otherwise(True)).collect()
    assert [(r.fam_id, r.dad.a2) for r in dads] == [("F2", 1)]


@pytest.mark.parametrize("name", ["g13_xlr_and_hom_var", "ag17_trio_gt_counts", "ag18_baf_medians", "ag9_denovo_rates", "j13_partial_trios"])
def test_entries_are_shuffled_once_and_read_once(spark, name):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = registry.QUERIES[name](spark, DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        logical = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert logical.count("Relation [l_orderkey") == 1
    assert "Exchange hashpartitioning(s#" not in plan  # no entry travels to its sample's trios
