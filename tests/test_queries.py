"""Registered queries against their SQL on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from kinlake.plans import evidence_queries, registry, site_queries, sv_queries, trio_queries  # noqa: F401

DIR = "/root/testdata/sf0.001"
SAMPLE = ["g1_denovo_posterior", "g2_mendel_codes", "g4_g5_phase_and_transmission", "g6_tdt", "ag1_variant_qc", "ag3_sex_aware_site_stats", "j5_overlap_reciprocal", "j8_coverage_fraction", "w3_merge_intervals", "g10_prioritize_csq", "g19_family_filter", "m14_c_alpha", "w18_rebin_coverage", "ag16_review_consensus"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")


def plain(v):
    if isinstance(v, float | Decimal):
        return "nan" if math.isnan(v) else round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{DIR}/{name}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_the_sql(spark, oracle, name):
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(map(plain, r)) for r in oracle.sql(f"select {', '.join(f'"{c}"' for c in cols)} from ({registry.ORACLE_SQL[name]})").fetchall()), key=key)
    assert got == want and got


def test_every_query_has_a_name_of_its_own():
    assert len(registry.QUERIES) > 150 and set(registry.ORACLE_SQL) <= set(registry.QUERIES) and registry.FLAGSHIP in registry.QUERIES


def test_binomial_p_is_worked_out_once_a_pair_of_counts(spark):
    plan = registry.QUERIES["p6_binomial_pab"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Project") and plan.index("sequence(") < plan.index("Aggregate [")
