"""Models whose coding sequence lacks its start or stop codon, mended along the genome; exons brought in line with that.

Models: ``mrna, seqid, strand``. Coding parts: ``mrna, start, end, phase`` (closed). The genome is a store of pieces
(:mod:`.genome`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import STARTS, STOPS, codons, first_of
from ..written import written
from .genome import SIZE, lengths, searched, texts


def in_translation(models: DataFrame, cds: DataFrame) -> DataFrame:
    """Coding parts with ``seqid``, ``strand``, their place in translation (``n`` from 1, ``parts``) and the coding bases
    ``before`` them (``total``: of all parts)."""
    t = cds.select("mrna", "start", "end", "phase").join(models.select("mrna", "seqid", "strand"), "mrna")
    along = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    w, all_ = Window.partitionBy("mrna").orderBy(along, "end"), Window.partitionBy("mrna")
    size = F.col("end") - F.col("start") + 1
    t = t.withColumn("n", F.row_number().over(w)).withColumn("before", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)) - size)
    return t.withColumn("parts", F.count(F.lit(1)).over(all_)).withColumn("total", F.sum(size).over(all_))


def coding_text(parts: DataFrame, store: DataFrame, skip: str, most: str, size: int = SIZE) -> DataFrame:
    """``mrna, text``: ``most`` coding bases after the first ``skip`` (two columns of ``parts``), across introns."""
    lo = F.greatest(F.col(skip) - F.col("before"), F.lit(0))
    hi = F.least(F.col(skip) + F.col(most) - F.col("before"), F.col("end") - F.col("start") + 1)
    minus = F.col("strand") == "-"
    t = parts.withColumn("_lo", lo).withColumn("_hi", hi).where("_hi > _lo")
    t = t.withColumn("_s", F.when(minus, F.col("end") - F.col("_hi") + 1).otherwise(F.col("start") + F.col("_lo"))).withColumn("_e", F.when(minus, F.col("end") - F.col("_lo")).otherwise(F.col("start") + F.col("_hi") - 1))
    return texts(store, t.select("mrna", "seqid", "strand", F.col("_s").alias("start"), F.col("_e").alias("end")), ["mrna"], size)


def end_codons(models: DataFrame, cds: DataFrame, store: DataFrame, size: int = SIZE) -> DataFrame:
    """``mrna, first, last``: the first codon after the phase of a model's first coding part, and its last three coding
    bases; null where fewer than three bases are left."""
    t = in_translation(models, cds)
    phase = F.max(F.when(F.col("n") == 1, F.col("phase"))).over(Window.partitionBy("mrna"))
    t = written(t.withColumn("skip", F.coalesce(phase, F.lit(0)).cast("long")).withColumn("tail", F.col("total") - 3).withColumn("three", F.lit(3).cast("long")).where("total - skip >= 3"), "parts")
    first = coding_text(t, store, "skip", "three", size).withColumnRenamed("text", "first")
    last = coding_text(t, store, "tail", "three", size).withColumnRenamed("text", "last")
    return cds.select("mrna").distinct().join(first, "mrna", "left").join(last, "mrna", "left")


def _first_start(parts: DataFrame, store: DataFrame, starts: Sequence[str], first: int, size: int) -> DataFrame:
    """``mrna, codons``: how many codons stand before the first start codon of a coding sequence that has three more
    bases after it; null if there is none. Read in windows, as :func:`.genome.searched` does."""
    rest, out, width = parts.withColumn("skip", F.lit(0).cast("long")), None, first
    while True:
        rest = rest.withColumn("most", F.lit(width).cast("long"))
        seen = coding_text(rest, store, "skip", "most", size).withColumn("hit", first_of(codons(F.col("text")), starts))
        one = rest.groupBy("mrna").agg(F.first("skip").alias("skip"), F.first("total").alias("total")).join(seen, "mrna", "left")
        one = written(one.select("mrna", "skip", "total", (F.col("skip") / 3 + F.col("hit") - 1).cast("long").alias("codons")), "starts")
        ended = F.col("codons").isNotNull() | (F.col("skip") + width >= F.col("total"))
        over = one.where(ended).select("mrna", F.when(F.col("total") - 3 * F.col("codons") >= 6, F.col("codons")).alias("codons"))
        out = over if out is None else out.unionByName(over)
        go_on = one.where(~ended).select("mrna", (F.col("skip") + width).alias("_skip"))
        if go_on.isEmpty():
            return out
        rest = rest.join(go_on, "mrna").withColumn("skip", F.col("_skip")).drop("_skip")
        width *= 4


def mended(models: DataFrame, cds: DataFrame, store: DataFrame, starts: Sequence[str] = STARTS, stops: Sequence[str] = STOPS, window: int = 999, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """``(status, cds)``: ``mrna, needed, ok``, and the coding parts after mending.

    A model whose last three bases are no stop codon is brought into frame at its end and extended to the next stop
    codon of the genome. Then one whose first codon is no start codon is extended against the strand to the next stop
    codon, and cut down to the first start codon behind that, wherever in its coding parts it lies. What is not found
    leaves the end as it was; ``ok`` says that all that was tried was found (true where nothing was needed)."""
    store_length = lengths(store, size)
    at_ends = end_codons(models, cds, store, size)
    no_stop, no_start = ~F.coalesce(F.col("last").isin(*stops), F.lit(False)), ~F.coalesce(F.col("first").isin(*starts), F.lit(False))
    state = written(at_ends.select("mrna", no_stop.alias("no_stop"), no_start.alias("no_start")), "ends")
    parts = in_translation(models, cds).join(store_length, "seqid").join(state, "mrna")
    minus = F.col("strand") == "-"

    # the stop: back to a whole codon, then ahead
    over = F.pmod(F.col("end") - F.col("start") + 1 - F.col("phase"), F.lit(3))
    tail = parts.where("no_stop AND n = parts").withColumn("edge", F.when(minus, F.col("start") + over).otherwise(F.col("end") - over))
    stop = written(searched(tail, store, stops, True, window, size).select("mrna", F.col("place").alias("stop")), "stops")
    parts = parts.join(stop, "mrna", "left")
    moved = F.col("stop").isNotNull() & (F.col("n") == F.col("parts"))
    parts = parts.withColumn("_s", F.when(moved & minus, F.col("stop")).otherwise(F.col("start"))).withColumn("end", F.when(moved & ~minus, F.col("stop")).otherwise(F.col("end"))).withColumn("start", F.col("_s"))
    parts = written(parts.select("mrna", "seqid", "strand", "start", "end", "phase", "n", "length", "no_stop", "no_start", "stop"), "stopped")

    # the start: against the strand to a stop, then along the coding parts to a start
    head = parts.where("no_start AND n = 1").withColumn("edge", F.when(minus, F.col("end") - F.col("phase") + 1).otherwise(F.col("start") + F.col("phase")))
    # searched() passes the edge itself, which is the model's first whole base
    before = head.withColumn("edge", F.when(minus, F.col("edge") - 1).otherwise(F.col("edge")))
    upstream = written(searched(before, store, stops, False, window, size).where("place IS NOT NULL").select("mrna", F.col("place").alias("up")), "upstream")
    wide = parts.join(upstream, "mrna").withColumn("phase", F.when(F.col("n") == 1, F.lit(0)).otherwise(F.col("phase")))
    wide = wide.withColumn("_s", F.when((F.col("n") == 1) & ~minus, F.col("up")).otherwise(F.col("start"))).withColumn("end", F.when((F.col("n") == 1) & minus, F.col("up")).otherwise(F.col("end"))).withColumn("start", F.col("_s"))
    wide = written(in_translation(models, wide.select("mrna", "start", "end", "phase")), "widened")
    found = _first_start(wide, store, starts, window, size).where("codons IS NOT NULL")
    cut = 3 * F.col("codons") - F.col("before")
    kept = wide.join(found, "mrna").withColumn("cut", F.greatest(cut, F.lit(0))).where("end - start + 1 > cut")
    started = kept.select("mrna", F.when(minus, F.col("start")).otherwise(F.col("start") + F.col("cut")).alias("start"), F.when(minus, F.col("end") - F.col("cut")).otherwise(F.col("end")).alias("end"), F.when(F.col("cut") > 0, F.lit(0)).otherwise(F.col("phase")).alias("phase"))
    started = written(started, "started")
    done = started.select("mrna").distinct()
    out = parts.join(done, "mrna", "left_anti").select("mrna", "start", "end", "phase").unionByName(started)
    ok = (~F.col("no_stop") | F.col("stop").isNotNull()) & (~F.col("no_start") | F.col("_done").isNotNull())
    status = state.join(stop, "mrna", "left").join(done.withColumn("_done", F.lit(True)), "mrna", "left")
    return status.select("mrna", (F.col("no_stop") | F.col("no_start")).alias("needed"), ok.alias("ok")), out


def repaired_exons(cds: DataFrame, exons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(exons, introns)`` of models (``mrna, start, end``): introns lie between neighbouring coding parts, and between
    neighbouring exons where they touch none of those (nor one before them); exons are what introns leave of the whole
    span. A model's parts are gathered as an array, which is as long as the model has parts."""
    part = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    both = cds.select("mrna", F.lit(True).alias("_cds"), part.alias("_p")).unionByName(exons.select("mrna", F.lit(False).alias("_cds"), part.alias("_p")))
    t = both.groupBy("mrna").agg(*(F.array_sort(F.collect_list(F.when(w, F.col("_p")))).alias(k) for k, w in (("c", F.col("_cds")), ("e", ~F.col("_cds")))))

    def between(parts: str):
        """Gaps of at least one base between each part and the next."""
        pairs = F.zip_with(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda a, b: F.struct((a["end"] + 1).cast("long").alias("start"), (b["start"] - 1).cast("long").alias("end")))
        return F.filter(pairs, lambda g: g["end"] >= g["start"])

    def add(known, gap):
        clash = F.exists(known, lambda k: (k["start"] <= gap["end"]) & (k["end"] >= gap["start"]))
        return F.when(clash, known).otherwise(F.concat(known, F.array(gap)))

    t = t.withColumn("i", F.array_sort(F.aggregate(between("e"), between("c"), add)))
    every = F.concat("c", "e")
    lo, hi = F.array_min(F.transform(every, lambda p: p["start"])), F.array_max(F.transform(every, lambda p: p["end"]))
    t = written(t.select("mrna", lo.alias("lo"), hi.alias("hi"), "i"), "introns")  # replays of gaps would else be repeated for each use
    begin = F.concat(F.array("lo"), F.transform("i", lambda g: g["end"] + 1))
    stop = F.concat(F.transform("i", lambda g: g["start"] - 1), F.array("hi"))
    t = t.withColumn("x", F.arrays_zip(begin.alias("start"), stop.alias("end")))
    return t.select("mrna", F.inline("x").alias("start", "end")), t.select("mrna", F.inline("i").alias("start", "end"))


def outside(cds: DataFrame, exons: DataFrame, models: DataFrame) -> DataFrame:
    """``mrna, type, start, end``: untranslated pieces of exons. An exon that meets no coding part is one as a whole; one that
    ends with a coding part gives what lies before it, one that begins with it what lies behind. Pieces up to the least
    coding position, or from the second least on, get their type by strand; others go."""
    part = F.struct(F.col("start").alias("s"), F.col("end").alias("e"))
    coding = cds.groupBy("mrna").agg(F.collect_list(part).alias("_c")).join(models.select("mrna", "strand").hint("merge"), "mrna")
    marks = F.array_sort(F.array_distinct(F.concat(F.transform("_c", lambda c: c["s"]), F.transform("_c", lambda c: c["e"]))))
    coding = coding.withColumn("_low", F.get(marks, F.lit(0))).withColumn("_high", F.get(marks, F.lit(1)))
    start, end = F.col("start"), F.col("end")
    piece = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
    t = exons.select("mrna", "start", "end").join(coding.hint("merge"), "mrna").withColumn("_met", F.filter("_c", lambda c: (c["s"] <= end) & (c["e"] >= start)))
    before = F.transform(F.filter("_met", lambda c: (start < c["s"]) & (end == c["e"])), lambda c: piece(start, c["s"] - 1))
    behind = F.transform(F.filter("_met", lambda c: (start == c["s"]) & (end > c["e"])), lambda c: piece(c["e"] + 1, end))
    t = t.select("mrna", "strand", "_low", "_high", F.inline(F.when(F.size("_met") == 0, F.array(piece(start, end))).otherwise(F.concat(before, behind))).alias("start", "end"))
    low, high = F.col("end") <= F.col("_low"), F.col("start") >= F.col("_high")
    minus, five, three = F.col("strand") == "-", F.lit("five_prime_UTR"), F.lit("three_prime_UTR")
    kind = F.when(minus, F.when(high, five).when(low, three)).otherwise(F.when(low, five).when(high, three))
    return t.select("mrna", kind.alias("type"), "start", "end").where("type IS NOT NULL")


#: How ids name a feature, and where it stands among features that begin together.
SHOWN = {"five_prime_UTR": ("utr5p", 1), "exon": ("exon", 2), "CDS": ("CDS", 3), "intron": ("intron", 4), "three_prime_UTR": ("utr3p", 5)}


def other_attributes(col: str) -> Column:
    """Attributes without ID and Parent, each followed by a semicolon."""
    kept = F.filter(F.transform(F.split(col, ";"), lambda a: F.trim(a)), lambda a: (a != "") & ~F.lower(a).startswith("id") & ~F.lower(a).startswith("parent"))
    return F.when(F.size(kept) > 0, F.concat(F.array_join(kept, ";"), F.lit(";"))).otherwise("")


def numbered(models: DataFrame, parts: DataFrame, known: DataFrame) -> DataFrame:
    """Features of models as rows in order: ``mrna, place, seqid, type, start, end, score, strand, attributes``.

    ``parts`` (``mrna, type, start, end``) are numbered by mRNA and type along the strand, but untranslated pieces by
    position; they stand in order of their starts along the strand, then of their types. A part that ``known`` has with
    the same place, strand and type (``mrna, seqid, strand, type, start, end, score, attributes, line_no``) keeps its score and
    further attributes, those of the last such line."""
    table = F.create_map(*(F.lit(x) for k, (name, rank) in SHOWN.items() for x in (k, F.struct(F.lit(name).alias("name"), F.lit(rank).alias("rank")))))
    key = ["mrna", "seqid", "strand", "type", "start", "end"]
    # what is known comes as an array per model, so that rows stay where their model is
    was = known.dropna(subset=[*key]).where(F.col("line_no").isNotNull()).groupBy("mrna").agg(F.collect_list(F.struct("line_no", *(F.col(c).alias(f"_{c}") for c in key[1:]), "score", other_attributes("attributes").alias("more"))).alias("_known"))
    t = parts.join(models.select("mrna", "seqid", "strand").hint("merge"), "mrna").withColumn("_t", F.try_element_at(table, F.col("type")))
    minus = F.col("strand") == "-"
    along = F.when(minus, -F.col("start")).otherwise(F.col("start"))
    by = F.when(minus & ~F.col("type").endswith("_UTR"), -F.col("start")).otherwise(F.col("start"))
    same = lambda k: (k["_type"] == F.col("type")) & (k["_start"] == F.col("start")) & (k["_end"] == F.col("end")) & (k["_seqid"] == F.col("seqid")) & (k["_strand"] == F.col("strand"))
    t = t.withColumn("_k", F.row_number().over(Window.partitionBy("mrna", "type").orderBy(by, "end"))).withColumn("place", F.row_number().over(Window.partitionBy("mrna").orderBy(along, F.col("_t.rank"), "end")))
    # numbered rows stand by their model already: what is known meets them last, so that sorts have narrow rows
    t = t.join(was.hint("merge"), "mrna", "left").withColumn("_old", F.array_max(F.filter("_known", same)))
    text = F.concat(F.lit("ID="), "mrna", F.lit("."), F.col("_t.name"), F.col("_k").cast("string"), F.lit(";Parent="), "mrna", F.lit(";"), F.coalesce("_old.more", F.lit("")))
    return t.select("mrna", "place", "seqid", "type", "start", "end", F.col("_old.score").alias("score"), "strand", text.alias("attributes"))
