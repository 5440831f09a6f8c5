"""Fuzzy line dedup, with DataFrame functions only.

Lines are normalised to their lower-cased words. Lines with equal words are one class. Each class gets a SimHash of
``BLOCKS`` blocks: a word's hash deals it to one block, and the distinct words of a block vote on its 15 bits. By the
pigeonhole principle two lines whose differing words touch at most ``BLOCKS - 2`` blocks agree in two whole blocks, so
any two choices of blocks are a join key (with the blocks' numbers of words, ``LEAST`` or more together; below
``FEW``, also with the line's). Lines that differ in two replaced words always meet, whatever their length, if the words
they share fill such a pair of blocks. Pairs that meet are linked if their edit similarity (1 - Levenshtein distance / longer length) is at least
``similarity``. Of each connected group of lines, the first occurrence (by document, then line) stays and all others
go. Lines of fewer than ``min_words`` words are never touched.

The words' votes are counted in one-byte counters, eight to a long, by an aggregate that Spark combines before it
shuffles. Keys are dealt once, with the numbers of classes alone; the texts of classes that share a key are looked up once
for all comparisons. Buckets of two classes are a pair; inside larger ones classes are first compared with the most central
one, and then only across components.

Cases: null texts stay null; empty texts and lines stay; a row is known by its id and its text, so rows that repeat an
id keep their own lines, rows equal in both lose the same lines, and null ids are rows like others (the last in order);
an empty table gives no rows; columns of other names pass through, whatever they are called.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graph import cross_pairs, link_buckets
from .scratch import Scratch, if_small, read

#: One ASCII character that is neither letter nor digit nor line feed, each named singly: Java looks such a set up in a
#: table, which is faster than comparing with ranges.
SEPARATORS = "[" + "".join(f"\\x{c:02x}" for c in [*range(10), *range(11, 48), *range(58, 97), *range(123, 128)]) + "]+"

#: Blocks of the SimHash, words that two blocks need to be a join key, and words below which the key also has the number
#: of the line's distinct words.
BLOCKS, LEAST, FEW = 6, 3, 6

#: One-byte counters hold the votes of at most so many words (their sum must stay positive).
CHUNK = 127

#: Edits that the first comparisons of two lines allow for: most pairs are settled in a narrow band.
BANDS = (16, 64, 256, 1024)

ROW = ["doc_id", "th", "line_no"]


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """The lines that take part: ``doc_id, th`` (the row), ``line_no, norm, n_words`` and a 128-bit identity ``c1, c2``.

    ``norm`` has the line's words, lower-cased runs of letters, digits and characters beyond ASCII, with one blank
    between two. A text is normalised in one go before it is split, so that the test of a line's length, which Spark
    moves down to the generator, doesn't do that work again.
    """
    whole = F.split(F.regexp_replace(F.lower("text"), SEPARATORS, " "), "\n")
    rows = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(whole).alias("line_no", "line"))
    rows = rows.select(*ROW, F.trim("line").alias("norm"))
    rows = rows.select("*", (F.length("norm") - F.length(F.replace("norm", F.lit(" "))) + 1).alias("n_words"))
    rows = rows.where((F.col("n_words") >= min_words) & (F.col("norm") != ""))
    return rows.select("*", F.xxhash64("norm").alias("c1"), F.xxhash64(F.lit(7), "norm").alias("c2"))


def _or(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def blocks(lines: DataFrame) -> DataFrame:
    """``doc_id, th, line_no, c1, c2, n_chars``, and for each block j its code ``b{j}`` and number of words ``n{j}``.

    The last counter of a block counts its words; a bit is set if more than half of them have it. Lines of more words
    than a counter holds are counted in chunks, whose counters are unpacked and added up.
    """
    key = [*ROW, "c1", "c2", "n_chars"]
    zero, wide, ones = F.lit(0).cast("long"), F.lit(0x00FF00FF00FF00FF), F.lit(0x0001000100010001)
    words = lines.select(*ROW, "c1", "c2", F.length("norm").alias("n_chars"), (F.col("n_words") > CHUNK).alias("long_line"), F.posexplode(F.array_distinct(F.split("norm", " "))).alias("at", "w"))
    votes = words.select(*key, "long_line", F.floor(F.col("at") / CHUNK).cast("int").alias("chunk"), F.xxhash64("w").alias("h"))
    x, y = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(0x0101010101010101)), F.shiftrightunsigned("h", 7).bitwiseAND(F.lit(0x0101010101010100)).bitwiseOR(F.lit(1))
    votes = votes.select(*key, "long_line", "chunk", F.pmod("h", F.lit(BLOCKS)).alias("block"), x.alias("x"), y.alias("y"))
    sums = [F.sum(F.when(F.col("block") == j, F.col(c)).otherwise(zero)).alias(f"{c}{j}") for j in range(BLOCKS) for c in "xy"]
    counted = votes.groupBy(*key, "long_line", "chunk").agg(*sums)

    def byte(c: str, i: int) -> Column:
        return F.shiftrightunsigned(c, 8 * i).bitwiseAND(F.lit(255))

    def decided(j: int) -> list[Column]:
        n = byte(f"y{j}", 0)
        limit = (F.lit(255).cast("long") - F.shiftright(n, 1)) * ones
        bits = [F.shiftleft(F.shiftrightunsigned(F.shiftrightunsigned(f"{c}{j}", s).bitwiseAND(wide) + limit, 8).bitwiseAND(ones), k) for k, (c, s) in enumerate((("x", 0), ("x", 8), ("y", 0), ("y", 8)))]
        return [_or(bits).alias(f"b{j}"), n.cast("int").alias(f"n{j}")]

    short = counted.where("NOT long_line").select(*key, *(c for j in range(BLOCKS) for c in decided(j)))
    lanes = [(j, c, i) for j in range(BLOCKS) for c in "xy" for i in range(8)]
    total = counted.where("long_line").groupBy(*key).agg(*(F.sum(byte(f"{c}{j}", i)).alias(f"{c}{j}_{i}") for j, c, i in lanes))

    def added(j: int) -> list[Column]:
        n = F.col(f"y{j}_0")
        at = {("x", 0): 0, ("x", 1): 1, ("y", 0): 2, ("y", 1): 3}
        bits = [F.when(F.col(f"{c}{j}_{i}") * 2 > n, F.lit(1 << (16 * (i // 2) + at[c, i % 2]) if 16 * (i // 2) + at[c, i % 2] < 63 else -(1 << 63)).cast("long")).otherwise(zero) for c in "xy" for i in range(8)]
        return [_or(bits).alias(f"b{j}"), n.cast("int").alias(f"n{j}")]

    return short.unionByName(total.select(*key, *(c for j in range(BLOCKS) for c in added(j))))


def keys() -> Column:
    """The join keys of a class: every two blocks with ``LEAST`` words or more. Few words say little, so they only count
    among lines of equally many distinct words."""
    all_words = sum((F.col(f"n{j}").cast("int") for j in range(1, BLOCKS)), F.col("n0").cast("int"))

    def key(i: int, j: int) -> Column:
        n = F.col(f"n{i}").cast("int") + F.col(f"n{j}").cast("int")
        size = F.when(n < FEW, all_words).otherwise(F.lit(0))
        return F.when(n >= LEAST, F.xxhash64(F.lit(i * BLOCKS + j), f"b{i}", f"b{j}", F.col(f"n{i}").cast("int"), F.col(f"n{j}").cast("int"), size))

    return F.array_compact(F.array(*(key(i, j) for i, j in combinations(range(BLOCKS), 2))))


def _stripped(a: Column, b: Column) -> Column:
    """``a`` and ``b`` without what they begin with alike, but for up to seven characters."""
    steps = F.array(*[F.lit(1 << k) for k in range(16, 2, -1)])

    def step(s: Column, n: Column) -> Column:
        alike = (F.least(F.length(s["a"]), F.length(s["b"])) >= n) & (F.substring(s["a"], F.lit(1), n) == F.substring(s["b"], F.lit(1), n))
        return F.when(alike, F.struct(F.substring(s["a"], n + 1, F.length(s["a"])).alias("a"), F.substring(s["b"], n + 1, F.length(s["b"])).alias("b"))).otherwise(s)

    return F.aggregate(steps, F.struct(a.alias("a"), b.alias("b")), step)


def cores(both: DataFrame, similarity: float) -> DataFrame:
    """``a, b``, the edits that ``similarity`` allows for (``most``), and ``s`` with the two texts ``ta, tb`` (reversed)
    without what they begin and end with alike: that doesn't change their distance."""
    most = F.floor((1 - similarity) * F.greatest(F.length("ta"), F.length("tb")) + 1e-9).cast("int")
    begun = F.array(_stripped(F.col("ta"), F.col("tb")))  # a lambda's argument is worked out once
    ended = F.transform(begun, lambda s: _stripped(F.reverse(s["a"]), F.reverse(s["b"])))
    return both.select("a", "b", most.alias("most"), F.get(ended, F.lit(0)).alias("s"))


#: Of ``cores``: each band is tried only if the one before left the pair open.
SIMILAR = "abs(length(s.a) - length(s.b)) <= most AND (" + " OR ".join(f"(most > {low} AND levenshtein(s.a, s.b, {f'least(most, {high})' if high else 'most'}) >= 0)" for low, high in zip((-1, *BANDS), (*BANDS, 0), strict=True)) + ")"


def line_groups(docs: DataFrame, scratch: Scratch, min_words: int, similarity: float, small_rows: int) -> DataFrame:
    """Occurrences to remove: ``doc_id, th, line_no``."""
    lines = scratch.cut(lines_of(docs, min_words), "lines")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "line_no", "th"))
    codes = [F.min(f"{c}{j}").alias(f"{c}{j}") for j in range(BLOCKS) for c in "bn"]
    per = blocks(lines).groupBy("c1", "c2").agg(first.alias("first"), F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("m"), *codes)
    classes = scratch.cut(per.select("c1", "c2", "n", "m", "first", *(f"b{j}" for j in range(BLOCKS)), *(F.col(f"n{j}").cast("smallint").alias(f"n{j}") for j in range(BLOCKS)), F.monotonically_increasing_id().alias("node")), "classes")
    scratch.sweep()
    # keys are dealt once: a bucket's rows are counted where they lie, and only rows that share a key are kept
    keyed = classes.select(F.explode(keys()).alias("key"), "node")
    met = keyed.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("size > 1")
    met = scratch.cut(met, "met")
    scratch.sweep()
    two = met.where("size = 2").groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b").distinct()
    marks = classes.select("node", "m")
    rows = scratch.cut(met.where("size > 2").join(marks, "node").select("key", "size", "node", "m"), "rows")
    alike = f"greatest(x.m, y.m) * {similarity} <= least(x.m, y.m)"
    # the texts of all classes that share a key are looked up once, and not for each round of comparisons
    wanted = scratch.cut(met.select("node").distinct().join(classes.select("node", "c1", "c2", "first.line_no", "first.th"), "node"), "nodes")
    found = lines.join(wanted.hint("merge"), ["c1", "c2", "line_no", "th"])
    texts = scratch.cut(found.select("node", F.col("norm").alias("t")).dropDuplicates(["node"]), "texts")
    scratch.drop("nodes")
    scratch.sweep()

    def confirm(pairs: DataFrame, tag: str) -> DataFrame:
        """``a, b`` with the edit similarity asked for. Only candidates of fitting lengths get their texts."""
        both = pairs.join(marks.select(F.col("node").alias("a"), F.col("m").alias("ma")), "a").join(marks.select(F.col("node").alias("b"), F.col("m").alias("mb")), "b")
        pairs = scratch.cut(both.where(f"greatest(ma, mb) * {similarity} <= least(ma, mb)").select("a", "b"), f"{tag}-pairs")
        if pairs.isEmpty():
            return pairs
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
        found = scratch.cut(cores(both, similarity), f"{tag}-cores")
        links = scratch.cut(found.where(SIMILAR).select("a", "b"), f"{tag}-links")
        scratch.drop(f"{tag}-cores")
        scratch.sweep()
        return links

    labels = link_buckets(rows, confirm, lambda labels: cross_pairs(rows, labels, alike), scratch, rounds=1, more_pairs=two)
    grouped = classes.join(labels, "node", "left").select("c1", "c2", "n", "first", F.coalesce("comp", "node").alias("grp"))
    groups = grouped.groupBy("grp").agg(F.sum("n").alias("all"), F.min("first").alias("stays")).where("all > 1")
    again = scratch.cut(grouped.join(groups, "grp").select("c1", "c2", "stays"), "again")
    repeats = lines.select(*ROW, "c1", "c2").join(if_small(again, small_rows), ["c1", "c2"])
    stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("line_no") == F.col("stays.line_no")) & (F.col("th") == F.col("stays.th"))
    return repeats.where(~stays).select(*ROW)


def line_dedup(docs: DataFrame, min_words: int = 5, similarity: float = 0.8, small_rows: int = 20_000) -> DataFrame:
    """``docs`` with the columns they came with, ``text`` without the lines that go, and last the number of these:
    ``removed_lines`` (with underscores before it if ``docs`` has that name)."""
    scratch = Scratch(docs.sparkSession, "lines")
    gone = line_groups(docs.select("doc_id", "text"), scratch, min_words, similarity, small_rows)
    per_doc = scratch.cut(gone.groupBy(F.col("doc_id").alias("id"), "th").agg(F.collect_set("line_no").alias("gone")), "gone")
    scratch.release("gone")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("text").alias("row_th"))
    out = rows.join(if_small(per_doc, small_rows), F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th")), "left")
    every = F.split("row.text", "\n")
    left = lambda e: F.sort_array(F.array_except(F.sequence(F.lit(0), F.size(e) - 1), F.col("gone")))
    kept = F.get(F.transform(F.array(every), lambda e: F.array_join(F.transform(left(e), lambda i: F.get(e, i)), "\n")), F.lit(0))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(kept)
    name = "removed_lines"
    while name in docs.columns:
        name = "_" + name
    return out.select(*(text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns), F.coalesce(F.size("gone"), F.lit(0)).alias(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))).otherwise(F.lit(0))
    return line_dedup(docs).select("doc_id", (n.cast("long")).alias("n_lines_left"), F.col("removed_lines").cast("long").alias("n_removed"), "text")
