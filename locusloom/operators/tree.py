"""Gene -> mRNA -> child trees of feature tables: linking, cleaning with cascades, ordering and renumbering.

Features have ``line_no``, ``seqid``, ``source``, ``type``, ``start``, ``end`` (closed), ``strand``, ``id`` and ``parents`` (an array). Ids are
taken to be unique among genes and mRNAs. Rows that share a line number are ordered by what else they hold, so numbers
never depend on the order in which Spark meets them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..written import written
from .chains import rooted
from .sweep import _ranged, carried, within

CHILD_TYPES = ("exon", "CDS")


def in_line() -> list[Column]:
    """A total order of features: by line, then by all that tells rows of one line apart."""
    return [F.col("line_no"), F.col("start"), F.col("end"), F.col("type"), F.col("id"), F.array_join("parents", ",")]


def line_range(t: DataFrame, rows: int = 100_000) -> int:
    """A width of line numbers that holds about ``rows`` rows if they are spread evenly. Line numbers of files have gaps
    between splits; a range then holds the lines of one split at most."""
    lo, hi, n = t.agg(F.min("line_no"), F.max("line_no"), F.count("line_no")).first()
    return max(1, (hi - lo) // max(1, n // rows) + 1) if n else 1


def _lines(t: DataFrame, value: Column | None, by: Sequence[str] = (), size: int | None = None, heads: DataFrame | None = None) -> DataFrame:
    """``t`` with ``_last``: the struct ``value`` (which begins with the line number) of the latest line up to the current
    one that has it, within ``by``. Of rows of one line, the largest struct counts for all. With ``heads`` (``by``, ``line_no``,
    ``_v``) the structs come from there, so that what is known of a head needs no join with the rows that follow it.

    What lies before a range enters as a row of that range: rows are shuffled and sorted once."""
    size = size or line_range(t)
    ranged = lambda x: x.withColumn("_range", _ranged(by, F.col("line_no"), size)).withColumn("_first", F.lit(1))
    rows = ranged(t.withColumn("_asks", F.lit(True)))
    if heads is None:
        rows = rows.withColumn("_v", value)
    else:
        rows = rows.unionByName(ranged(heads), allowMissingColumns=True)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*by, "_range").agg(F.max("_v").alias("_v")).withColumn("_v", F.max("_v").over(before)).where("_v IS NOT NULL").withColumn("_first", F.lit(0))
    to_here = Window.partitionBy(*by, "_range").orderBy("_first", "line_no").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.unionByName(carry, allowMissingColumns=True).withColumn("_last", F.max("_v").over(to_here))
    return met.where("_asks").select(*t.columns, "_last")


def forward_fill(t: DataFrame, value: str, to: str, by: Sequence[str] = ()) -> DataFrame:
    """``to``: the last value of ``value`` that isn't null, in line order (within ``by``, such as a file)."""
    held = F.when(F.col(value).isNotNull(), F.struct("line_no", F.col(value).alias("x")))
    return _lines(t, held, by).withColumn(to, F.col("_last.x")).drop("_last")


def linked(features: DataFrame) -> DataFrame:
    """Every feature with its ``gene`` and ``mrna``. ``superlocus`` rows go, and so do children that follow an
    ``ncRNA_gene`` before the next gene, or whose parent is no known mRNA of their sequence. An mRNA whose gene is
    missing there stays, with a null gene. Children that repeat an id within an mRNA are told apart as ``_2``, ``_3``."""
    genes, mrnas, below = linked_apart(features)
    return genes.unionByName(mrnas).unionByName(below)


def linked_apart(features: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What :func:`linked` gives, as genes, mRNAs and the rows below them. What reads them one by one need not write the whole,
    and rows below stay where their mRNA is."""
    parent = F.element_at("parents", 1)
    tops, rest = written(features.where("type IN ('gene', 'ncRNA_gene')"), "tops"), features.where("type NOT IN ('superlocus', 'mRNA', 'gene', 'ncRNA_gene')")
    genes = tops.where("type = 'gene'").select("seqid", F.col("id").alias("gene")).distinct()
    mrnas = features.where("type = 'mRNA'").withColumn("_gene", parent)
    mrnas = mrnas.join(genes.select(F.col("seqid").alias("_s"), "gene").hint("merge"), (F.col("seqid") == F.col("_s")) & (F.col("_gene") == F.col("gene")), "left").drop("_s", "_gene")
    mrnas = written(mrnas.withColumn("mrna", F.col("id")), "mrnas")
    known = mrnas.select(F.col("seqid").alias("_s"), F.col("id").alias("_m"), "gene").dropDuplicates(["_s", "_m"])
    # only what stands below mRNAs asks for the gene before it: other rows come as heads or stay out of the way
    heads = tops.select("line_no", F.struct("line_no", (F.col("type") == "gene").alias("coding")).alias("_v"))
    rest = _lines(rest, None, heads=heads).where(F.coalesce("_last.coding", F.lit(True))).drop("_last").withColumn("mrna", parent)
    rest = rest.join(known.hint("merge"), (F.col("seqid") == F.col("_s")) & (F.col("mrna") == F.col("_m"))).drop("_s", "_m")
    k = F.row_number().over(Window.partitionBy("seqid", "mrna", "id").orderBy(*in_line()))
    rest = rest.withColumn("id", F.when(k > 1, F.concat("id", F.lit("_"), k.cast("string"))).otherwise(F.col("id")))
    top = tops.where("type = 'gene'").select("*", F.col("id").alias("gene"), F.lit(None).cast("string").alias("mrna"))
    return top, mrnas.select(*top.columns), rest.select(*top.columns)


Tree = DataFrame | tuple[DataFrame, DataFrame, DataFrame]


def _apart(tree: Tree) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Genes, mRNAs and the rows below them, of which mRNAs are read more than once."""
    if isinstance(tree, tuple):
        return tree
    tree = written(tree, "tree")
    return tree.where("mrna IS NULL"), tree.where("type = 'mRNA'"), tree.where("type <> 'mRNA' AND mrna IS NOT NULL")


def closure(features: DataFrame) -> DataFrame:
    """Every feature with ``root`` and ``depth``: the top of its line of (first) parents and the steps up to it, at any depth,
    by pointer jumping. A row without a parent is its own root; one whose parent is missing counts as such a row
    (``orphan``). On a circle of parents, and below one, root and depth are null."""
    up = F.element_at("parents", 1)
    ids = features.where("id IS NOT NULL").groupBy("id").agg(F.min_by(F.struct(up.alias("up")), F.struct("line_no", "start", "end")).alias("_p")).select("id", F.col("_p.up").alias("up"))
    top = rooted(ids, "id", "up").select(F.col("id").alias("_i"), F.col("root").alias("_r"), F.col("depth").alias("_d"))
    t = features.withColumn("_up", up).join(top.hint("merge"), F.col("_up") == F.col("_i"), "left")
    lone, orphan = F.col("_up").isNull(), F.col("_up").isNotNull() & F.col("_i").isNull()
    t = t.withColumn("root", F.when(lone | orphan, F.col("id")).otherwise(F.col("_r"))).withColumn("depth", F.when(lone | orphan, F.lit(0).cast("long")).otherwise(F.col("_d") + 1))
    return t.withColumn("orphan", orphan).drop("_up", "_i", "_r", "_d")


def without_below(features: DataFrame, gone: DataFrame) -> DataFrame:
    """``features`` without the ids in ``gone`` (``id``) and without all rows, at any depth, whose every parent goes. Each
    round takes away one level of parents; rows of several parents stay while one of them does."""
    ids = gone.select("id").distinct()
    while True:
        bad = written(ids.select(F.col("id").alias("_bad")), "gone")
        named = features.where("size(parents) > 0").select("line_no", "id", F.explode("parents").alias("_p")).join(bad, F.col("_p") == F.col("_bad"), "left")
        lost = named.groupBy("line_no", "id").agg(F.bool_and(F.col("_bad").isNotNull()).alias("all")).where("all")
        more = lost.where("id IS NOT NULL").select("id").distinct().join(bad, F.col("id") == F.col("_bad"), "left_anti")
        more = written(more, "lost")
        if more.isEmpty():
            left = features.join(bad, F.col("id") == F.col("_bad"), "left_anti")
            return left.join(lost.select("line_no"), "line_no", "left_anti")
        ids = bad.select(F.col("_bad").alias("id")).unionByName(more)


def without_mrnas(features: DataFrame, bad: DataFrame) -> DataFrame:
    """``features`` without the mRNAs in ``bad`` (``mrna``), without genes that lose all their mRNAs by that, and without
    children all of whose parents go."""
    bad = bad.select(F.col("mrna").alias("_bad")).distinct()
    gone = bad.unionByName(_emptied(features, bad))
    kept = features.where("type IN ('gene', 'mRNA')").join(gone, F.col("id") == F.col("_bad"), "left_anti")
    return kept.unionByName(_with_parent_left(features.where("type NOT IN ('gene', 'mRNA')"), bad))


def _emptied(features: DataFrame, bad: DataFrame) -> DataFrame:
    """Genes (``_bad``) all of whose mRNAs are ``_bad``."""
    mrnas = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), F.element_at("parents", 1).alias("gene")).join(bad, F.col("mrna") == F.col("_bad"), "left")
    return mrnas.groupBy("gene").agg(F.bool_and(F.col("_bad").isNotNull()).alias("all")).where("all").select(F.col("gene").alias("_bad"))


def _with_parent_left(rest: DataFrame, bad: DataFrame) -> DataFrame:
    """``rest`` without rows all of whose parents are ``_bad``, and without lines that hold no other rows."""
    some = rest.select("line_no", F.explode_outer("parents").alias("_p")).join(bad, F.col("_p") == F.col("_bad"), "left_anti").select("line_no").distinct()
    return rest.join(some, "line_no", "left_semi")


def lost_with_mrnas(features: DataFrame, bad: DataFrame) -> DataFrame:
    """``type, id`` of which :func:`without_mrnas` leaves no row. An id stays while any of its rows keeps a parent, so rows meet
    what goes once, by what they hang on, and are not put together again by line."""
    bad = written(bad.select(F.col("mrna").alias("_bad")).distinct(), "bad")
    top = F.col("type").isin("gene", "mRNA")
    gone = bad.unionByName(_emptied(features, bad)).select(F.col("_bad"), F.lit(True).alias("_top")).distinct()
    gone = gone.unionByName(bad.select("_bad", F.lit(False).alias("_top")))
    hangs = features.where("id IS NOT NULL").select("type", "id", top.alias("_is_top"), F.explode_outer(F.when(top, F.array("id")).otherwise(F.col("parents"))).alias("_on"))
    met = hangs.join(gone.hint("merge"), (F.col("_on") == F.col("_bad")) & (F.col("_is_top") == F.col("_top")), "left")
    return met.groupBy("type", "id").agg(F.bool_and(F.col("_bad").isNotNull()).alias("_all")).where("_all").select("type", "id")


def childless(features: DataFrame, any_child: bool = False) -> DataFrame:
    """mRNAs without an exon or CDS; with ``any_child``, without any child at all."""
    rest = features.where("type NOT IN ('gene', 'mRNA')") if any_child else features.where(F.col("type").isin(*CHILD_TYPES))
    has = rest.select(F.explode("parents").alias("mrna")).distinct()
    return features.where("type = 'mRNA'").select(F.col("id").alias("mrna")).join(has, "mrna", "left_anti")


def strand_conflicts(features: DataFrame) -> DataFrame:
    """mRNAs with an exon or CDS on another strand than another's or their own."""
    rest = features.where(F.col("type").isin(*CHILD_TYPES)).select(F.explode("parents").alias("mrna"), "strand")
    own = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), "strand")
    known = own.select("mrna")
    both = rest.join(known, "mrna", "left_semi").unionByName(own)
    return both.groupBy("mrna").agg(F.count_distinct("strand").alias("n")).where("n > 1").select("mrna")


def assert_strands(features: DataFrame) -> None:
    """Raise if any mRNA has a strand conflict."""
    first = strand_conflicts(features).limit(5).collect()
    if first:
        raise ValueError("strand conflicts in " + ", ".join(sorted(r.mrna for r in first)))


def chimeric(features: DataFrame, most_exons: int = 110, most_residues: int = 20_000) -> DataFrame:
    """mRNAs with too many exon rows or too long a CDS: ``mrna, exons, cds_bp``."""
    rest = features.where(F.col("type").isin(*CHILD_TYPES)).select(F.explode("parents").alias("mrna"), "type", (F.col("end") - F.col("start") + 1).alias("n"))
    g = rest.groupBy("mrna").agg(F.count_if(F.col("type") == "exon").alias("exons"), F.coalesce(F.sum(F.when(F.col("type") == "CDS", F.col("n"))), F.lit(0).cast("long")).alias("cds_bp"))
    return g.where((F.col("exons") > most_exons) | (F.col("cds_bp") / 3 > most_residues))


def invalid_training(features: DataFrame) -> DataFrame:
    """mRNAs without a CDS, or with CDS that overlap or touch in one base."""
    cds = features.where("type = 'CDS'").select(F.explode("parents").alias("mrna"), "start", "end")
    w = Window.partitionBy("mrna").orderBy("start", "end")
    broken = cds.withColumn("_prev", F.lag("end").over(w)).where("start <= _prev").select("mrna").distinct()
    mrnas = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"))
    none = mrnas.join(cds.select("mrna").distinct(), "mrna", "left_anti")
    return mrnas.join(broken, "mrna", "left_semi").unionByName(none).distinct()


def beyond_end(features: DataFrame, lengths: DataFrame) -> DataFrame:
    """``features`` without genes that end past their sequence (``seqid``, ``length``) and without all below them."""
    gone = features.where("type = 'gene'").join(lengths, "seqid").where("end > length").select(F.col("id").alias("_gone"))
    first = features.where("type <> 'gene'").select("id", F.explode("parents").alias("_p")).join(gone, F.col("_p") == F.col("_gone")).select(F.col("id").alias("_gone"))
    out = gone.unionByName(first).distinct()
    left = features.join(out, F.col("id") == F.col("_gone"), "left_anti")
    below = left.select("line_no", F.explode("parents").alias("_p")).join(out, F.col("_p") == F.col("_gone"), "left_semi").select("line_no").distinct()
    return left.join(below, "line_no", "left_anti")


#: What names a chromosome, as opposed to a contig.
CHROMOSOME = "^(Chr|chr|LG|Ch|[0-9])"


def order_key(pattern: str = CHROMOSOME) -> list[Column]:
    """Sort keys of ``seqid``: chromosomes first by prefix and the rest as text, then contigs by number, others last."""
    prefix = F.regexp_extract("seqid", f"({pattern})", 1)
    rest = F.regexp_replace("seqid", pattern, "")
    number = F.col("seqid").try_cast("double")
    return [F.when(prefix != "", 0).otherwise(1), prefix, F.when(prefix != "", rest).otherwise(""), F.when(prefix == "", number).asc_nulls_last(), F.col("seqid")]


def places(tree: Tree, pattern: str = CHROMOSOME) -> DataFrame:
    """Linked features with their place in a sorted file, as three numbers: ``seq_place`` (sequences by
    :func:`order_key`), ``gene_place`` (genes, and mRNAs without one, by start) and ``inner_place`` (mRNAs by start, each
    followed by its children as they stood). Ties go by line."""
    genes, mrnas, below = _apart(tree)
    cols = genes.columns
    tops = written(genes.select("seqid", F.col("gene").alias("_top"), "start", "line_no").unionByName(mrnas.where("gene IS NULL").select("seqid", F.col("mrna").alias("_top"), "start", "line_no")), "tops")
    every = tops.select("seqid").unionByName(mrnas.select("seqid")).distinct()
    sequences = every.select("seqid", F.row_number().over(Window.orderBy(*order_key(pattern))).alias("seq_place"))
    ranked = carried(tops, ["seqid"], F.col("start"), 4096, {"_b": F.count(F.lit(1))})
    ranked = ranked.select("seqid", "_top", (F.coalesce("_b", F.lit(0).cast("long")) + F.count(F.lit(1)).over(within(["seqid"], "start", "line_no", "_top"))).alias("gene_place"))
    ranked = written(ranked.join(sequences.hint("merge"), "seqid"), "ranked")
    # rows below stand by their mRNA already: they are counted there and take along where it stands
    of = mrnas.groupBy("seqid", "mrna").agg(F.max(F.struct(F.col("start").alias("_ms"), F.col("line_no").alias("_ml"), F.coalesce("gene", "mrna").alias("_top"))).alias("_m")).select("seqid", "mrna", "_m.*")
    w = Window.partitionBy("seqid", "mrna").orderBy(*in_line())
    below = below.withColumn("_k", F.row_number().over(w)).join(of.hint("merge"), ["seqid", "mrna"])
    mrnas = mrnas.withColumns({"_k": F.lit(0), "_ms": F.col("start"), "_ml": F.col("line_no"), "_top": F.coalesce("gene", "mrna")})
    genes = genes.withColumns({"_k": F.lit(0), "_ms": F.lit(None).cast("long"), "_ml": F.lit(None).cast("long"), "_top": F.col("gene")})
    more = [*cols, "_k", "_ms", "_ml", "_top"]
    t = genes.select(*more).unionByName(mrnas.select(*more)).unionByName(below.select(*more)).join(ranked.hint("merge"), ["seqid", "_top"])
    inside = Window.partitionBy("seqid", "_top").orderBy(F.col("mrna").isNotNull(), "_ms", "_ml", "mrna", "_k")
    return t.select(*cols, "seq_place", "gene_place", F.row_number().over(inside).alias("inner_place"))


def in_order(tree: Tree, pattern: str = CHROMOSOME) -> DataFrame:
    """Linked features in file order, by a range sort: no task holds everything."""
    return places(tree, pattern).orderBy("seq_place", "gene_place", "inner_place").drop("seq_place", "gene_place", "inner_place")


def chromosome_tag(seqid: Column, digits: Column | int, suffix: str = "G") -> Column:
    """Part of a gene id that names the chromosome: its number, zero-padded, and a letter; other names as they are."""
    rest = F.regexp_replace(seqid, "^(Chr|chr|LG|Ch)", "")
    width = digits if isinstance(digits, Column) else F.lit(digits)
    number = F.regexp_replace(rest, "^0+(?=.)", "")
    padded = F.lpad(number, F.greatest(F.length(number), width), F.lit("0"))
    plain = F.lpad(seqid, F.greatest(F.length(seqid), width), F.lit("0"))
    named = F.when(rest == "", seqid).otherwise(rest)
    return F.when(seqid.rlike("^(Chr|chr|LG|Ch)"), F.concat(F.when(rest.rlike("^[0-9]+$"), padded).otherwise(named), F.lit(suffix))).when(seqid.rlike("^[0-9]"), F.concat(plain, F.lit(suffix))).otherwise(seqid)


def renumbered(tree: Tree, prefix: str, width: int = 6, digits: int = 1, splice: str = "t", by_sequence: bool = True) -> DataFrame:
    """Linked features with ``new_id``: genes ``prefix`` [+ chromosome] + number + ``0`` by start, isoforms ``.t1`` by start, and
    children ``.cds1`` numbered by mRNA and type. With ``by_sequence`` genes count anew on each sequence."""
    top, mrnas, below = _apart(tree)
    cols = top.columns
    rank = top.select("seqid", "gene", "start", "line_no")
    group = ["seqid"] if by_sequence else []
    numbered = carried(rank, group, F.col("start"), 4096, {"_b": F.count(F.lit(1))})
    number = F.coalesce("_b", F.lit(0).cast("long")) + F.count(F.lit(1)).over(within(group, "start", "line_no", "seqid", "gene"))
    text = number.cast("string")
    padded = F.concat(F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")), F.lit("0"))
    tag = chromosome_tag(F.col("seqid"), digits) if by_sequence else F.lit("")
    genes = written(numbered.select("seqid", "gene", F.concat(F.lit(prefix), tag, padded).alias("_new_gene")), "numbers")
    iso = F.row_number().over(Window.partitionBy("seqid", "gene").orderBy("start", "line_no", "mrna"))
    mrnas = mrnas.where("gene IS NOT NULL").withColumn("_iso", iso).join(genes.hint("merge"), ["seqid", "gene"])
    mrnas = written(mrnas.select(*cols, F.concat("_new_gene", F.lit(f".{splice}"), F.col("_iso").cast("string")).alias("new_id")), "mrnas")
    # rows below stand by their mRNA already, which knows its gene's number
    kind = F.lower("type")
    k = F.row_number().over(Window.partitionBy("seqid", "mrna", kind).orderBy(*in_line()))
    below = below.withColumn("_k", k).join(mrnas.select("seqid", "mrna", F.col("new_id").alias("_new")).hint("merge"), ["seqid", "mrna"])
    below = below.withColumn("new_id", F.concat("_new", F.lit("."), kind, F.col("_k").cast("string")))
    top = top.join(genes.hint("merge"), ["seqid", "gene"]).withColumn("new_id", F.col("_new_gene"))
    return top.select(*cols, "new_id").unionByName(mrnas.select(*cols, "new_id")).unionByName(below.select(*cols, "new_id"))


def id_map(renamed: DataFrame) -> DataFrame:
    return renamed.select("type", F.col("id").alias("old_id"), "new_id")


def transcripts(features: DataFrame) -> DataFrame:
    """``transcript_id, gene, seqid, start, end`` of mRNA and transcript rows."""
    return features.where("type IN ('mRNA', 'transcript')").select(F.col("id").alias("transcript_id"), F.element_at("parents", 1).alias("gene"), "seqid", "start", "end", "line_no")


def primary(features: DataFrame) -> DataFrame:
    """The isoform with the longest CDS of each gene; ties go to the first line: ``gene, mrna, cds_bp``."""
    cds = features.where("type = 'CDS'").select(F.explode("parents").alias("mrna"), (F.col("end") - F.col("start") + 1).alias("n")).groupBy("mrna").agg(F.sum("n").alias("cds_bp"))
    m = features.where("type = 'mRNA'").select(F.col("id").alias("mrna"), F.element_at("parents", 1).alias("gene"), "line_no").join(cds, "mrna")
    w = Window.partitionBy("gene").orderBy(F.desc("cds_bp"), "line_no", "mrna")
    return m.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("gene", "mrna", "cds_bp")


def single_exon_mrnas(features: DataFrame) -> DataFrame:
    """``mrna, exons, single``: by exon rows, or by CDS rows where there are none."""
    rest = features.where(F.col("type").isin(*CHILD_TYPES)).select(F.explode("parents").alias("mrna"), "type")
    g = rest.groupBy("mrna").agg(F.count_if(F.col("type") == "exon").alias("_e"), F.count_if(F.col("type") == "CDS").alias("_c"))
    m = features.where("type = 'mRNA'").select(F.col("id").alias("mrna")).join(g, "mrna", "left")
    n = F.coalesce(F.when(F.col("_e") > 0, F.col("_e")).otherwise(F.col("_c")), F.lit(0).cast("long"))
    return m.select("mrna", n.alias("exons"), (n <= 1).alias("single"))


def benchmark_count(features: DataFrame) -> DataFrame:
    """Number of gene rows, or of mRNA rows if there are no genes: one row."""
    return features.agg(F.coalesce(F.nullif(F.count_if(F.col("type") == "gene"), F.lit(0)), F.count_if(F.col("type") == "mRNA")).alias("n"))


def upper_median(t: DataFrame, col: str) -> DataFrame:
    """The value in the middle (the upper one of two) as ``median``, by running counts over ranges of values."""
    g = t.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    g = written(g.repartitionByRange("_v").withColumn("_at", F.spark_partition_id()), "ranges")
    c = carried(g, [], F.col("_at"), 1, {"_b": F.sum("_n")})
    c = c.withColumn("_run", F.coalesce("_b", F.lit(0).cast("long")) + F.sum("_n").over(within([], "_v")))
    total = g.agg(F.sum("_n").alias("_all"))
    return c.crossJoin(F.broadcast(total)).agg(F.min(F.when(F.col("_run") > F.floor(F.col("_all") / 2), F.col("_v"))).alias("median"))


def flank_length(genes: DataFrame, least: int = 200, size: int = 4096) -> DataFrame:
    """Flank for training models: an eighth of the median distance between neighbouring genes of a sequence, at most the
    median gene length and at least ``least``: ``gene_median, gap_median, flank``."""
    top = carried(genes.select("seqid", "start", "end"), ["seqid"], F.col("start"), size, {"_top": F.max("end")}, "max")
    gap = F.col("start") - F.greatest("_top", F.max("end").over(within(["seqid"], "start", "end", to=-1))) - 1
    apart = top.select(F.greatest(gap, F.lit(0).cast("long")).alias("gap")).where("gap IS NOT NULL")
    a = upper_median(genes.select((F.col("end") - F.col("start") + 1).alias("n")), "n").withColumnRenamed("median", "gene_median")
    b = upper_median(apart, "gap").withColumnRenamed("median", "gap_median")
    return a.crossJoin(b).withColumn("flank", F.greatest(F.lit(least), F.least(F.floor(F.col("gap_median") / 8), F.col("gene_median"))))


def stretched(tree: Tree, spans: DataFrame) -> DataFrame:
    """mRNA and outer exon bounds of the genes in ``spans`` (``gene``, ``new_start``, ``new_end``) moved to the new span."""
    genes, mrnas, below = _apart(tree)
    new = ["new_start", "new_end"]
    spans = spans.select("gene", *new)
    genes, mrnas = (t.join(spans.hint("merge"), "gene", "left").withColumn("_left", F.lit(True)).withColumn("_right", F.lit(True)) for t in (genes, mrnas))
    # exons stand by their mRNA already, which takes the span along; they look at their mRNA's other exons
    of = mrnas.where("new_start IS NOT NULL").groupBy("seqid", "mrna").agg(F.max(F.struct(*new)).alias("_n")).select("seqid", "mrna", "_n.*")
    exon = F.col("type") == "exon"
    lo, hi = (f(F.when(exon, F.col("start" if f is F.min else "end"))).over(Window.partitionBy("seqid", "mrna")) for f in (F.min, F.max))
    below = below.withColumn("_lo", lo).withColumn("_hi", hi).join(of.hint("merge"), ["seqid", "mrna"], "left")
    below = below.withColumn("_left", exon & (F.col("start") == F.col("_lo"))).withColumn("_right", exon & (F.col("end") == F.col("_hi")))

    def moved(t: DataFrame) -> DataFrame:
        has = F.col("new_start").isNotNull()
        t = t.withColumn("start", F.when(has & F.col("_left"), F.col("new_start")).otherwise(F.col("start"))).withColumn("end", F.when(has & F.col("_right"), F.col("new_end")).otherwise(F.col("end")))
        return t.drop("_left", "_right", "_lo", "_hi", *new)

    cols = moved(genes).columns
    return moved(genes).unionByName(moved(mrnas).select(*cols)).unionByName(moved(below).select(*cols))
