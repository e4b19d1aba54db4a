"""Transcript consequences: decoding, encoding, ranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Consequence terms from most to least severe, as the annotator documents them (fixed values).
HIGH = ["transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "stop_lost"]
MEDIUM = ["start_lost", "initiator_codon_variant", "transcript_amplification", "inframe_insertion", "inframe_deletion", "missense_variant", "protein_altering_variant", "splice_region_variant"]
LOW = ["incomplete_terminal_codon_variant", "start_retained_variant", "stop_retained_variant", "synonymous_variant", "coding_sequence_variant"]
NON_CODING = [
    "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant", "non_coding_exon_variant", "intron_variant", "NMD_transcript_variant",
    "non_coding_transcript_variant", "nc_transcript_variant", "upstream_gene_variant", "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification", "TF_binding_site_variant",
    "regulatory_region_ablation", "regulatory_region_amplification", "feature_elongation", "regulatory_region_variant", "feature_truncation", "intergenic_variant",
]
ORDER = [*HIGH, *MEDIUM, *LOW, *NON_CODING, ".", "NA"]
# Terms of the coding classes (fixed values).
CODING = ["coding_sequence_variant", "frameshift_variant", "incomplete_terminal_codon_variant", "inframe_deletion", "inframe_insertion", "missense_variant", "protein_altering_variant", "splice_acceptor_variant", "splice_donor_variant", "start_lost", "stop_gained", "stop_lost", "stop_retained_variant", "synonymous_variant"]
CLASSES = {
    "isPTV": ["frameshift_variant", "stop_gained", "splice_donor_variant", "splice_acceptor_variant", "transcript_ablation"],
    "isMIS": ["missense_variant"],
    "isSYN": ["synonymous_variant", "stop_retained_variant"],
    "isSRG": ["splice_region_variant"],
    "isSSL": ["start_lost", "stop_lost"],
    "isINF": ["inframe_insertion", "inframe_deletion"],
}
# Terms that the clinical filter drops and keeps (fixed values).
EXCLUDED = ["intergenic_variant", "upstream_gene_variant", "downstream_gene_variant", "synonymous_variant", "coding_sequence_variant", "sequence_variant"]
SPLICE_OR_KEPT = ["splice_donor_5th_base_variant", "splice_region_variant", "splice_donor_region_variant", "non_coding_transcript_exon_variant"]


def texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def decode(csq: Column, columns: list[str]) -> Column:
    """Array of pipe-joined texts to an array of structs; Consequence becomes an array. A text of one field is missing: '.' everywhere."""

    def one(text: Column) -> Column:
        parts = F.split(text, r"\|")
        single = F.size(parts) <= 1
        field = lambda i: F.when(single, F.lit(".")).otherwise(F.coalesce(F.get(parts, F.lit(i)), F.lit("")))
        return F.struct(*[(F.split(field(i), "&") if c == "Consequence" else field(i)).alias(c) for i, c in enumerate(columns)])

    return F.transform(csq, one)


def encode(transcripts: Column, columns: list[str]) -> Column:
    """Array of structs back to comma-joined texts."""
    field = lambda t, c: F.array_join(t[c], "&") if c == "Consequence" else t[c]
    return F.array_join(F.transform(transcripts, lambda t: F.concat_ws("|", *[field(t, c) for c in columns])), ",")


def severity(terms: Column) -> Column:
    """Rank of the most severe of the terms; null if none is known."""
    known = F.transform(terms, lambda t: F.array_position(texts(ORDER), t))
    return F.array_min(F.filter(known, lambda p: p > 0)) - 1


def most_severe(terms: Column) -> Column:
    return F.get(texts(ORDER), severity(terms).cast("int"))


def score(t: Column, loftee: bool = False) -> Column:
    """A transcript's score, the lower the worse: its severity, later if not coding or not canonical, else a little earlier by the
    predicted damage (loftee: first by the loss-of-function call)."""
    s = severity(t["Consequence"]).cast("double")
    out = F.when(t["BIOTYPE"] != "protein_coding", s + 600).when(t["CANONICAL"] != "YES", s + 500)
    if loftee:
        out = out.when((t["LoF"] == "HC") & (t["LoF_flags"] == ""), s - 1000).when((t["LoF"] == "HC") & (t["LoF_flags"] != ""), s - 500).when(t["LoF"] == "LC", s - 10)
    for word, less in (("probably_damaging", 0.5), ("possibly_damaging", 0.25), ("benign", 0.1)):
        out = out.when(F.contains(t["PolyPhen"], F.lit(word)), s - less)
    return out.otherwise(s)


def canonical_or_all(transcripts: Column) -> Column:
    canonical = F.filter(transcripts, lambda t: t["CANONICAL"] == "YES")
    return F.when(F.size(canonical) > 0, canonical).otherwise(transcripts)


def ranked(transcripts: Column, loftee: bool = False) -> Column:
    """Transcripts as structs (score, place, symbol, csq), worst first; of equal scores the earlier listed."""
    rows = F.transform(canonical_or_all(transcripts), lambda t, i: F.struct(score(t, loftee).alias("score"), i.alias("place"), t["SYMBOL"].alias("symbol"), t.alias("csq")))
    return F.array_sort(F.filter(rows, lambda r: r["score"].isNotNull()))


def transcript_kept(t: Column, by_csq: bool = True, by_impact: bool = True) -> Column:
    """Whether a transcript passes the clinical filter: not only excluded terms; canonical or a MANE addition; HIGH or MODERATE impact
    or a splice or kept term."""
    out = (t["CANONICAL"] == "YES") | (F.coalesce(t["MANE_PLUS_CLINICAL"], F.lit("")) != "")
    if by_csq:
        out = out & (F.size(F.array_except(t["Consequence"], texts(EXCLUDED))) > 0)
    if by_impact:
        out = out & (F.arrays_overlap(t["Consequence"], texts(SPLICE_OR_KEPT)) | t["IMPACT"].isin("HIGH", "MODERATE"))
    return out
