"""Rows of pairs and samples that compete, and the corrected pedigree."""

from kinlake.operators import pedigree, related

PED = "family_id string, sample_id string, paternal_id string, maternal_id string, sex int, phenotype int"


def test_corrected_pedigree(spark):
    given = [("F", "kid", "dad", "mom", 1, 2), ("F", "dad", None, None, 1, 1), ("F", "mom", None, None, 2, 1), ("G", "g", "h", None, 1, 1), ("H", "alone", None, None, 1, 1), ("I", "odd", None, None, 1, 1), ("J", "kept", "x", "y", 1, 1)]
    found = [
        ("F", "kid", "dad", None, 1, 2),  # differs, the father is a sample and not its child: goes
        ("F", "dad", "far", "mom", 1, 1),  # differs, but both parents are there: stays
        ("F", "mom", None, "odd", 2, 1),  # its mother is a sample, and mom is the mother of odd: both links go
        ("G", "g", "h", None, 1, 1),  # agrees: stays with one parent
        ("I", "odd", None, "mom", 1, 1),
        ("J", "kept", "nobody", None, 1, 1),  # the one parent is no sample: stays
        ("Z", "extra", None, None, 1, 1),  # not in the given pedigree
    ]
    table = lambda rows: spark.createDataFrame(rows, PED)
    got = {r.sample_id: (r.paternal_id, r.maternal_id) for r in pedigree.corrected_ped(table(given), table(found)).collect()}
    assert got == {"dad": ("far", "mom"), "mom": (None, None), "g": ("h", None), "odd": (None, None), "kept": ("nobody", None)}
    assert pedigree.corrected_ped(table(given), table([])).count() == 0


def test_unique_pairs(spark):
    rows = [
        ("a", "b", 0.2, "siblings", "siblings", 1), ("b", "a", 0.1, "siblings", "parent-child", 2), ("a", "b", 0.4, "related_other", "parent-child", 3), ("a", "b", None, None, None, 4),
        ("a", "c", 0.0, "unrelated", "unrelated", 5), ("c", "a", 0.0, "unrelated", "ambiguous", 6), ("a", "c", 0.3, "siblings", None, 7), ("d", "e", None, "siblings", "siblings", 8), ("e", "d", -0.1, "siblings", "siblings", 9),
    ]
    rel = spark.createDataFrame(rows, "i string, j string, kin double, ped_relationship string, relationship string, n int")
    first = sorted(r.n for r in related.unique_pairs(rel).collect())
    assert [n for n in first if n not in (5, 6)] == [2, 7, 9] and len(first) == 4
    assert sorted(r.n for r in related.unique_pairs(rel.repartition(3)).collect()) == first
    assert related.unique_pairs(rel.limit(0)).count() == 0


def test_unique_samples(spark):
    rows = [
        ("a", "Unknown", "parent-child", "parent-child", 0.5, 0.5, 1), ("a", "Mother", None, None, None, None, 2), ("b", "Proband", "parent-child", None, 0.1, None, 3), ("b", "Proband", "siblings", "siblings", 0.0, 0.0, 4),
        ("c", "Father", "siblings", None, 0.2, None, 5), ("c", "Father", None, "siblings", None, 0.3, 6), ("d", None, None, None, None, None, 8), ("d", "Singleton", None, None, None, None, 7),
    ]
    qc = spark.createDataFrame(rows, "sample_id string, role string, mother_status string, father_status string, mother_kin double, father_kin double, n int")
    assert sorted(r.n for r in related.unique_samples(qc).collect()) == [2, 4, 6, 8]
