"""Views that Spark reads by a plan of their own give the rows of their text."""

from pyspark.sql import functions as F

from kinlake.plans import views as V


def _customers(spark, tmp_path, keys):
    spark.createDataFrame([(k, 1) for k in keys], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_kinship_has_the_rows_of_its_text_without_comparing_all_pairs(spark, tmp_path):
    d = _customers(spark, tmp_path, [0, 1, 2, 3, 5, 5, 6, 9, 12, 16, 17, None])
    got = V.view(spark, d, "v_kinship")
    want = spark.sql(V.VIEWS["v_kinship"], customer=spark.read.parquet(f"{d}/customer.parquet"))
    key = lambda df: sorted(map(tuple, df.select(*[F.col(c).cast("string") for c in df.columns]).collect()))
    assert key(got) == key(want) and got.schema == want.schema and len(key(got)) > 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entries_have_the_rows_of_their_text_and_fewer_shuffles(spark):
    d = "/root/testdata/sf0.001"
    read = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    carriers = spark.sql(V.VIEWS["v_carriers"], lineitem=read("lineitem"), orders=read("orders"))
    want = spark.sql(V.VIEWS["v_entries"], v_carriers=carriers, customer=read("customer"), v_sites=spark.sql(V.VIEWS["v_sites"], part=read("part")))
    got = V.view(spark, d, "v_entries")
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own, text = plan(got.select("*")), plan(want.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert own < text, (own, text)


def test_trio_fields_leave_the_rest_behind_and_a_child_of_two_families_stays_twice(spark):
    from kinlake.operators import trio

    rows = [("chr1", 1, "A", "C", s, 0, a2, 30) for s, a2 in (("k", 1), ("f", 0), ("m", 0), ("n", 1))]
    entries = spark.createDataFrame(rows, "contig string, pos int, ref string, alt string, s string, a1 int, a2 int, DP int")
    trios = spark.createDataFrame([("F1", "k", "f", "m", True), ("F2", "k", "f", "m", False)], "fam_id string, proband string, father string, mother string, is_female boolean")
    out = trio.trio_entries(entries, trios, fields=trio.CALL)
    assert out.schema["kid"].dataType.names == ["s", "a1", "a2"]
    assert sorted((r.fam_id, r.father, r.mother, r.is_female, r.kid.a2, r.mom.a2) for r in out.collect()) == [("F1", "f", "m", True, 1, 0), ("F2", "f", "m", False, 1, 0)]


def test_ancestry_and_downsampling_work_out_their_rows_once(spark, monkeypatch):
    from kinlake.plans import site_queries as Q

    labels, write = [], Q.scratch.written
    monkeypatch.setattr(Q.scratch, "written", lambda df, label: labels.append(label) or write(df, label))
    df = Q.t2_downsample(spark, "/root/testdata/sf0.001")
    read = set(df.inputFiles())
    assert labels == ["flat"] and read and all("flat-" in f for f in read)
    entries, made = Q.V.entries, []
    monkeypatch.setattr(Q.V, "entries", lambda *a: made.append(1) or entries(*a))
    Q.m11_assign_ancestry(spark, "/root/testdata/sf0.001")
    assert len(made) == 1 and labels[-1] == "scores"
