"""Readers and writers."""

from kinlake.operators import sets
from kinlake.sources import files

VCF = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\nchr1\t10\t.\tA\tT,G\t50\tPASS\tAC=1,2;DB\tGT:AD:DP:GQ:PL\t0/1:10,5,0:15:40:9,0,9\t./.\nchrX\t20\trs1\tC\tCT\tnul\tLowQual\tAC=1\tGT:DP\t1:7\t0|1:8\n"


def test_vcf(spark, tmp_path):
    p = tmp_path / "a.vcf"
    p.write_text(VCF)
    sites = files.read_vcf_sites(spark, str(p), "nul", ".").orderBy("pos", "allele").collect()
    assert [(r.pos, r.alt, r.allele, r.filter, r.info) for r in sites] == [(10, "T", 1, [], {"AC": "1,2"}), (10, "G", 2, [], {"AC": "1,2"}), (20, "CT", 1, ["LowQual"], {"AC": "1"})]
    e = {(r.pos, r.s): r for r in files.read_vcf_entries(spark, str(p)).collect()}
    assert (e[10, "S1"].a1, e[10, "S1"].a2, e[10, "S1"].AD, e[10, "S1"].PL) == (0, 1, [10, 5, 0], [9, 0, 9])
    assert e[10, "S2"].a1 is None and (e[20, "S1"].a1, e[20, "S1"].a2, e[20, "S1"].GQ) == (1, 1, None) and e[20, "S2"].phased
    assert {r.s for r in files.read_vcf_entries(spark, str(p), ["S2"]).collect()} == {"S2"}


def test_bed_ped_tsv(spark, tmp_path):
    bed, ped, one, two = (tmp_path / n for n in ("x.bed", "x.ped", "a.tsv", "b.tsv"))
    bed.write_text("chrom\tstart\tend\nchr1\t5\t9\tn\n#c\nchr2\t1\t2\n")
    assert sorted((r.contig, r.start, r.end) for r in files.read_bed(spark, str(bed)).collect()) == [("chr1", 5, 9), ("chr2", 1, 2)]
    ped.write_text("family_id\tsample_id\tpaternal_id\tmaternal_id\tsex\tphenotype\textra\nF\ta\t0\t-9\t1\t1\tx\nF\tk\ta\tb\t2\t2\ty\nF\tk\ta\tb\t2\t2\ty\n")
    rows = {r.sample_id: r for r in files.read_ped(spark, str(ped)).collect()}
    assert len(rows) == 2 and rows["a"].paternal_id is None and rows["a"].maternal_id is None and rows["k"].sex == 2
    one.write_text("x\ty\n1\t2\n")
    two.write_text("x\tz\n3\t4\n")
    assert sorted((r.x, r.y, r.z) for r in files.read_tsvs(spark, [str(one), str(two)]).collect()) == [("1", "2", None), ("3", None, "4")]


def test_store_and_shards(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 1, "A", "T"), ("chr2", 2, "C", "G"), ("chr1", 3, "G", "A")], "contig string, pos int, ref string, alt string")
    files.save_table(df, str(tmp_path / "t"))
    assert sorted(map(tuple, files.load_table(spark, str(tmp_path / "t")).select("contig", "pos", "ref", "alt").collect())) == sorted(map(tuple, df.collect()))
    files.write_sites_vcf(df, str(tmp_path / "v"))
    assert spark.read.text(str(tmp_path / "v/body")).count() == 3 and spark.read.text(str(tmp_path / "v/header")).count() == 2
    files.write_sharded(df, str(tmp_path / "s"), shards=2)
    assert files.read_tsvs(spark, [str(tmp_path / "s")]).count() == 3
    assert [r.contig for r in sets.sort_variants(df).collect()] == ["chr1", "chr1", "chr2"]
