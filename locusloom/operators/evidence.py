"""Evidence tables: threshold flags, rule labels, tiers, cut-offs, and score curves.

Raw evidence stays nullable; flags never are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..written import written
from .interval import union_lengths
from .sweep import carried, measure, within


@dataclass(frozen=True)
class Cutoffs:
    """Fixed default values of the rule engine."""

    tpm: float = 3.0
    coverage: float = 0.5
    augustus: float = 0.8
    helixer: float = 0.8
    repeat: float = 0.5
    blast: float = 0.6
    rex: float = 0.6
    miniprot: float = 0.5
    noncoding: float = 0.9
    hexamer: float = 0.15


def above(col: str, cutoff: float) -> Column:
    """Strictly above; missing evidence does not pass."""
    return F.coalesce(F.col(col) > cutoff, F.lit(False))


def flags(t: DataFrame, c: Cutoffs = Cutoffs()) -> DataFrame:
    """Pass flags of the evidence columns. A missing repeat share counts as a repeat; one of the two BLAST measures
    alone is neither a hit nor the lack of one."""
    pident, qcovs = above("blast_pident", 100 * c.blast), above("blast_qcovs", 100 * c.blast)
    rex = above("rex_pident", 100 * c.rex) & above("rex_qcovs", 100 * c.rex)
    return t.select(
        "*", above("tpm", c.tpm).alias("f_tpm"), above("coverage", c.coverage).alias("f_cov"), above("augustus", c.augustus).alias("f_aug"), above("helixer", c.helixer).alias("f_hel"),
        F.coalesce(F.col("repeat") < c.repeat, F.lit(False)).alias("f_notrep"), F.coalesce(F.col("pfam"), F.lit(False)).alias("f_pfam"), above("lnc", 0.5).alias("f_lnc"),
        (~F.coalesce(F.col("single_exon"), F.lit(False))).alias("f_multi"), (pident & qcovs).alias("f_blast"), (~pident & ~qcovs).alias("f_noblast"), rex.alias("f_rex"),
    )


def seed_label(t: DataFrame) -> DataFrame:
    """``label``: Discard before Keep before the literal ``None``. Needs :func:`flags`."""
    cov, tpm, aug, hel, notrep, pfam, lnc, multi, blast, noblast, rex = (F.col(f"f_{x}") for x in "cov tpm aug hel notrep pfam lnc multi blast noblast rex".split())
    keep = (cov & ((blast & pfam) | (aug & hel))) | (multi & ~lnc & cov & tpm) | (multi & pfam & blast) | (aug & hel & ~rex & notrep & ~lnc & multi) | (blast & pfam)
    drop = (~cov & ~aug & ~hel & noblast & ~pfam) | (~multi & noblast & ~pfam & ~cov) | (rex & noblast & ~pfam) | (lnc & ~multi & ~pfam & ~aug & ~hel) | (aug & ~hel & noblast & ~pfam & ~cov)
    return t.withColumn("label", F.when(drop, "Discard").when(keep, "Keep").otherwise("None"))


#: Domains that mark a model as derived from a transposon, by name and by prefix, and borderline ones.
TE_DOMAINS = [
    "zf-RVT", "MULE", "DBD_Tnp_Mut", "rve", "SH3_retrovirus", "Dimer_Tnp_hAT", "hAT-like_RNase-H", "hATC", "Integrase_H2C2", "Integrase_Zn", "gag_pre-integrs", "Transpos_assoc", "Retrotransp-rel", "Peptidase_A17",
    "RT_RNaseH", "RT_RNaseH_2", "RVP_2", "Asp_protease_2", "gag-asp_proteas", "Pol_BBD", "SH3_Tf2-1", "ATHILA", "Ty3_capsid", "PEG10_N-capsid", "PEG10-RTL1_C-capsid", "PRO_PEG10-RTL1", "DUF4219",
    "Plant_tran", "DUF4371", "DUF659", "DUF4218", "TnsB_C", "Phage_integrase", "ZBED1_RNase-like", "ZBED1_RNase-like_helical", "zf-BED", "DUF4216", "DUF8418", "DUF8803", "DUF1633",
]
TE_PREFIXES = ["RVT_", "Transposase_", "DDE_Tnp_", "Retrotran_gag", "Retrotrans_gag"]
TE_BORDERLINE = ["SWIM", "PIF1", "Pif1_2B_dom", "zf-BED_2", "DUF1985", "zf-CCHC_4"]


def te_domain(name: str, borderline: bool = False) -> Column:
    """Whole names or prefixes, never parts of a name."""
    hit = F.col(name).isin(*TE_DOMAINS, *(TE_BORDERLINE if borderline else []))
    for p in TE_PREFIXES:
        hit = hit | F.col(name).startswith(p)
    return F.coalesce(hit, F.lit(False))


def te_only(domains: DataFrame, key: str = "transcript_id", name: str = "domain", borderline: bool = False) -> DataFrame:
    """Keys all of whose domains are transposon domains."""
    return domains.groupBy(key).agg(F.bool_and(te_domain(name, borderline)).alias("_only")).where("_only").select(key)


def withdraw_te_domains(t: DataFrame, te: DataFrame) -> DataFrame:
    """``f_pfam`` no longer holds for the transcripts in ``te``."""
    mark = te.select("transcript_id", F.lit(True).alias("_te"))
    return t.join(mark, "transcript_id", "left").withColumn("f_pfam", F.col("f_pfam") & F.col("_te").isNull()).drop("_te")


def strict_single_exon(t: DataFrame, subjects: bool = True) -> DataFrame:
    """Homology of single-exon models counts only by a curated hit (``curated``); that of others not if their best
    subject has one exon (``subject_exons``; asked only with ``subjects``). ``f_noblast`` becomes the complement."""
    single = F.coalesce(F.col("single_exon"), F.lit(False))
    valid = ~F.coalesce(F.col("subject_exons") == 1, F.lit(False)) if subjects else F.lit(True)
    hit = (~single & F.col("f_blast") & valid) | (single & F.coalesce(F.col("curated"), F.lit(False)))
    return t.withColumn("f_blast", hit).withColumn("f_noblast", ~F.col("f_blast"))


def noncoding_single(t: DataFrame, c: Cutoffs = Cutoffs(), second: str | None = None) -> DataFrame:
    """``f_noncoding``: single-exon models that score as non-coding (``noncoding_prob``, null as 0, and ``hexamer``, null
    as 1) and, with ``second``, that a second classifier (a boolean column) also calls non-coding."""
    called = (F.coalesce(F.col("noncoding_prob"), F.lit(0.0)) >= c.noncoding) & (F.coalesce(F.col("hexamer"), F.lit(1.0)) < c.hexamer)
    if second:
        called = called & F.coalesce(F.col(second), F.lit(False))
    return t.withColumn("f_noncoding", F.coalesce(F.col("single_exon"), F.lit(False)) & called)


def subject_exons(best: DataFrame, proteins: DataFrame, exons: DataFrame) -> DataFrame:
    """``query, subject_exons`` by two lookups: best subject -> transcript (``protein, transcript, line_no``; the first
    mapping wins) -> exons (``transcript``). A subject without a mapping gives null, one without exons 0."""
    first = first_by(proteins, "protein", F.asc("line_no")).select("protein", "transcript")
    counts = exons.groupBy("transcript").agg(F.count(F.lit(1)).alias("_n"))
    known = first.join(counts, "transcript", "left").select("protein", F.coalesce("_n", F.lit(0).cast("long")).alias("subject_exons"))
    return best.join(known, F.col("subject") == F.col("protein"), "left").select("query", "subject", "subject_exons")


def rule_overlaps(t: DataFrame, a: Column, b: Column, c: Column) -> DataFrame:
    """How many rows meet two of three rules at once: one row ``ab, ac, bc``."""
    return t.agg(F.count_if(a & b).alias("ab"), F.count_if(a & c).alias("ac"), F.count_if(b & c).alias("bc"))


def seed_with_noncoding(t: DataFrame) -> DataFrame:
    """:func:`seed_label` with its sixth way to Discard: non-coding single-exon models without domain and homology."""
    sixth = F.col("f_noncoding") & ~F.col("f_pfam") & F.col("f_noblast")
    return seed_label(t).withColumn("label", F.when(sixth, "Discard").otherwise(F.col("label")))


def curated(t: DataFrame, cutoff: float = 0.5, evidence: tuple[str, ...] = ("augustus", "helixer", "blast_pident")) -> DataFrame:
    """Rows labelled Keep, and undecided ones with evidence: any flag that reads as true, or coverage above the cutoff."""
    any_flag = F.lit(False)
    for c in evidence:
        any_flag = any_flag | truthy(F.col(c))
    return t.where((F.col("label") == "Keep") | ((F.col("label") == "None") & (any_flag | F.coalesce(F.col("coverage") > cutoff, F.lit(False)))))


def truthy(c: Column) -> Column:
    """1, 1.0, True and true."""
    return F.coalesce(c.cast("string").isin("1", "1.0", "True", "true"), F.lit(False))


def domain_hits(hits: DataFrame, least: float = 0.25, evalue: float = 1e-3, short: int = 80, strict: float = 1e-5) -> DataFrame:
    """Domain matches worth keeping: ``gene, domain, hmm_len, evalue, covered, coverage``. Matches of a gene and domain
    (``hmm_start``, ``hmm_end``, closed) are united; long models need the stricter e-value."""
    by = ["gene", "domain"]
    united = union_lengths(hits.select(*by, F.col("hmm_start").alias("start"), F.col("hmm_end").alias("end")), by, closed=True).drop("n")
    best = hits.groupBy(*by).agg(F.min("evalue").alias("evalue"), F.max("hmm_len").alias("hmm_len"))
    out = best.join(united, by).withColumn("coverage", F.col("covered") / F.col("hmm_len"))
    return out.where((F.col("coverage") >= least) & (F.col("evalue") <= evalue) & ((F.col("hmm_len") < short) | (F.col("evalue") <= strict)))


def feature_matrix(t: DataFrame, cols: list[str]) -> DataFrame:
    """Columns as doubles with 0 for what is missing or no number, and ``<col>_missing`` (0 or 1) for each."""
    number = {c: F.col(c).try_cast("double") if dict(t.dtypes)[c] == "string" else F.col(c).cast("double") for c in cols}
    return t.select("transcript_id", *(F.coalesce(number[c], F.lit(0.0)).alias(c) for c in cols), *(number[c].isNull().cast("int").alias(f"{c}_missing") for c in cols))


def discard_class(rex_pident: str = "rex_pident", lnc: str = "lnc") -> Column:
    return F.when(F.col(rex_pident) > 0, "TE_related").when(F.col(lnc) > 0.5, "lncRNA").otherwise("pseudogene")


def pseudogene_reason(t: DataFrame, cov_cutoff: float = 0.5, tpm_cutoff: float = 1.0, support: int = 2, exons: int = 2) -> DataFrame:
    """``reason``: B (frame shifts) over C (single exon, best subject spliced) over A (silent with homology); null if
    none or ``protected``. Columns: tpm, coverage, pfam, blast_pident, frameshifts, single_exon, subject_exons, protected."""
    nopfam = ~F.coalesce(F.col("pfam"), F.lit(False))
    low = F.coalesce(F.col("tpm"), F.lit(0.0)) < tpm_cutoff
    a = (F.coalesce(F.col("tpm"), F.lit(0.0)) == 0) & nopfam & (F.coalesce(F.col("coverage"), F.lit(0.0)) < cov_cutoff) & F.col("blast_pident").isNotNull()
    b = (F.coalesce(F.col("frameshifts"), F.lit(0)) >= support) & low & nopfam
    c = F.coalesce(F.col("single_exon"), F.lit(False)) & F.coalesce(F.col("subject_exons") >= exons, F.lit(False)) & low & nopfam
    return t.withColumn("reason", F.when(F.col("protected"), None).when(b, "B").when(c, "C").when(a, "A"))


def pseudogene_evidence(t: DataFrame, places: DataFrame, shifted: DataFrame, best: DataFrame, proteins: DataFrame, exons: DataFrame) -> DataFrame:
    """``t`` with what :func:`pseudogene_reason` asks for. ``frameshifts``: how many alignments with a frame shift
    (``shifted``: ``chrom``, closed ``b_start``, ``b_end``) overlap the transcript (``places``: ``transcript_id, chrom, start, end``,
    closed; 0 without a place). ``subject_exons``: exons of the best hit's transcript, by :func:`subject_exons`; null if
    that isn't known."""
    half_open = places.withColumn("end", F.col("end") + 1)
    n = measure(half_open, shifted.select("chrom", "b_start", (F.col("b_end") + 1).alias("b_end"))).groupBy("transcript_id").agg(F.max("n_overlaps").alias("frameshifts"))
    hop = subject_exons(best, proteins, exons).select(F.col("query").alias("transcript_id"), "subject_exons")
    return t.join(n, "transcript_id", "left").withColumn("frameshifts", F.coalesce("frameshifts", F.lit(0).cast("long"))).join(hop, "transcript_id", "left")


def first_by(t: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first in the given order (which must be total)."""
    return t.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def only_in(t: DataFrame, key: str, value: str, names: list[str], prefixes: list[str] = ()) -> DataFrame:
    """Keys all of whose values are in ``names`` or start with one of ``prefixes``."""
    hit = F.col(value).isin(*names)
    for p in prefixes:
        hit = hit | F.col(value).startswith(p)
    return t.groupBy(key).agg(F.bool_and(F.coalesce(hit, F.lit(False))).alias("only")).where("only").select(key)


def _ranked(t: DataFrame, col: str, descending: bool, sums: dict[str, Column]) -> DataFrame:
    """Distinct values of ``col`` with running ``sums`` in their order, by ranges of values whose bounds are sampled, so that
    a range holds about as many values as any other: no task orders all, however the values are spread."""
    g = t.where(F.col(col).isNotNull()).groupBy(col).agg(*(c.alias(k) for k, c in sums.items()))
    order = F.desc(col) if descending else F.asc(col)
    # the bounds hold for this table only, so that it is written with the number of each row's range
    g = written(g.repartitionByRange(order).withColumn("_at", F.spark_partition_id()), "ranges")
    g = carried(g, [], F.col("_at"), 1, {f"_{k}": F.sum(k) for k in sums})
    w = within([], F.desc(col) if descending else F.asc(col))
    return g.select(col, *sums, *((F.coalesce(f"_{k}", F.lit(0).cast("long")) + F.sum(k).over(w)).alias(f"run_{k}") for k in sums))


def quantile_cutoffs(t: DataFrame, col: str, low: float = 0.05, high: float = 0.95, floor_low: float | None = None, floor_high: float | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, not below their floors: one row."""
    r = _ranked(t, col, False, {"n": F.count(F.lit(1))})
    n = t.where(F.col(col).isNotNull()).agg(F.count(F.lit(1)).alias("_all"))
    r = r.crossJoin(F.broadcast(n))

    def at(q: float, floor: float | None) -> Column:
        place = (F.col("_all") - 1) * F.lit(q)
        below = F.min(F.when(F.col("run_n") > F.floor(place), F.col(col)))
        above = F.min(F.when(F.col("run_n") > F.ceil(place), F.col(col)))
        value = below + (above - below) * F.max(place - F.floor(place))
        return value if floor is None else F.greatest(value, F.lit(floor))

    return r.agg(at(low, floor_low).alias("p_low"), at(high, floor_high).alias("p_high"))


def soft_vote(repeat_high: Column, keep: Column) -> Column:
    """drop, keep or unsure. Columns: rex, repeat, lnc, internal_stop, short_orf."""
    drop = ((F.col("rex") > 0) & (F.col("repeat") >= repeat_high)) | (F.col("lnc") >= 0.6) | (F.col("internal_stop") > 0) | (F.col("short_orf") > 0)
    return F.when(drop, "drop").when(keep, "keep").otherwise("unsure")


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall and F1 at every distinct score."""
    r = _ranked(scored.select(F.col(score), F.col(label)), score, True, {"p": F.sum(F.col(label).cast("long")), "n": F.count(F.lit(1))})
    total = scored.where(F.col(score).isNotNull()).agg(F.sum(F.col(label).cast("long")).alias("all_p"))
    c = r.select(score, F.col("run_p").alias("tp"), F.col("run_n").alias("seen")).crossJoin(F.broadcast(total))
    precision, recall = F.col("tp") / F.col("seen"), F.col("tp") / F.nullif(F.col("all_p"), F.lit(0))
    return c.select(score, "tp", "seen", precision.alias("precision"), recall.alias("recall"), (2 * F.col("tp") / F.nullif(F.col("seen") + F.col("all_p"), F.lit(0))).alias("f1"))


def curve_summary(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: the area under the ROC curve (ties count half), average precision, and the highest F1 with the highest
    score that reaches it."""
    r = _ranked(scored.select(F.col(score), F.col(label)), score, True, {"p": F.sum(F.col(label).cast("long")), "n": F.count(F.lit(1))})
    total = scored.where(F.col(score).isNotNull()).agg(F.sum(F.col(label).cast("long")).alias("_p"), F.count(F.lit(1)).alias("_n"))
    r = r.crossJoin(F.broadcast(total))
    negatives = F.col("n") - F.col("p")
    area = F.sum(negatives * (F.col("run_p") - F.col("p") / 2)) / F.max(F.nullif(F.col("_p") * (F.col("_n") - F.col("_p")), F.lit(0)))
    average = F.sum(F.col("p") / F.col("_p") * F.col("run_p") / F.col("run_n"))
    f1 = 2 * F.col("run_p") / F.nullif(F.col("run_n") + F.col("_p"), F.lit(0))
    best = F.max(F.struct(f1.alias("f1"), F.col(score).alias("at")))
    return r.agg(area.alias("roc_auc"), average.alias("average_precision"), best.alias("best")).select("roc_auc", "average_precision", F.col("best.f1").alias("f1"), F.col("best.at").alias("threshold"))


def rescue_tier(repeat_cutoff: float = 0.5, least: float = 0.6) -> Column:
    """Which tier keeps an undecided gene: classifier, domain or conserved gene. A hit to a transposon without any BLAST
    hit bars the first. Columns: prob, rex_pident, blast_pident, pfam, repeat, busco."""
    zero = F.lit(0.0)
    te = (F.coalesce(F.col("rex_pident"), zero) > 0) & ~(F.coalesce(F.col("blast_pident"), zero) > 0)
    domain = F.coalesce(F.col("pfam"), F.lit(False)) & (F.coalesce(F.col("repeat"), zero) <= repeat_cutoff) & ~(F.coalesce(F.col("rex_pident"), zero) > 0)
    return F.when((F.col("prob") > least) & ~te, "classifier").when(domain, "domain").when(F.coalesce(F.col("busco"), F.lit(False)), "busco").otherwise("none")


def rescued(t: DataFrame, repeat_cutoff: float = 0.5) -> DataFrame:
    """``kept`` for every gene: seeded or predicted Keep, undecided with a tier, and all conserved genes whatever was
    decided about them. Columns: label and those of :func:`rescue_tier`."""
    tier = F.when(F.col("label") == "None", rescue_tier(repeat_cutoff)).otherwise("none")
    return t.select("*", tier.alias("tier")).withColumn("kept", (F.col("label") == "Keep") | (F.col("tier") != "none") | F.coalesce(F.col("busco"), F.lit(False)))


def merge_evidence(base: DataFrame, others: list[DataFrame], key: str = "transcript_id") -> DataFrame:
    """Left joins of evidence tables (one row per key) to ``base``; missing evidence stays null."""
    for o in others:
        base = base.join(o, key, "left")
    return base


def merge_features(tables: list[DataFrame], key: str = "gene_id") -> DataFrame:
    """Full outer joins of feature tables on the key; numeric gaps become 0."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full_outer")
    return out.na.fill(0)


def mean_over_samples(t: DataFrame, key: str, value: Column, samples: int | DataFrame) -> DataFrame:
    """Sum of ``value`` per key over the number of samples (also given as a one-row table ``n``): samples without the
    key count as 0."""
    g = t.groupBy(key).agg(F.sum(value).alias("_sum"))
    if isinstance(samples, DataFrame):
        return g.crossJoin(F.broadcast(samples)).select(key, (F.col("_sum") / F.col("n")).alias("mean"))
    return g.select(key, (F.col("_sum") / samples).alias("mean"))
