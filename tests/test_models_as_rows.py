"""Loci by assignment, merged and mended models, parents of any depth: against plain versions."""

import collections
import random
import re

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from locusloom.functions.attributes import set_attribute
from locusloom.ml import bagging
from locusloom.operators import assign, chains, ends, genome, modelset, scoring, sets, tree
from locusloom.sources import gff3, tables
from locusloom.written import written


def replay(genes, share=0.5):
    """Loci one gene after the other: lists of [founder, start, end] by sequence and strand."""
    loci, of = {}, {}
    for line, seqid, strand, start, end in sorted(genes):
        mine = loci.setdefault((seqid, strand), [])
        first = next((x for x in mine if x[1] <= end and x[2] >= start), None)
        if first and max(0, min(first[2], end) - max(first[1], start)) / (end - start + 1) >= share:
            first[1], first[2] = min(first[1], start), max(first[2], end)
        else:
            first = [line, start, end]
            mine.append(first)
        of[line] = first
    return of


def test_loci_by_assignment(spark):
    r = random.Random(11)
    for n, span in ((300, 4000), (200, 300)):
        lines = r.sample(range(10**6), n)
        genes = [(line, r.choice("ab"), r.choice("+-"), s := r.randrange(1, span), s + r.choice((0, 3, r.randrange(60), r.randrange(200)))) for line in lines]
        want = replay(genes)
        t = spark.createDataFrame(genes, "line_no long, seqid string, strand string, start long, end long").repartition(7)
        got, loci = assign.assigned(t, size=64)
        rank = {f: k + 1 for k, f in enumerate(sorted({x[0] for x in want.values()}))}
        assert {x.line_no: x.locus for x in got.collect()} == {line: rank[x[0]] for line, x in want.items()}
        assert {(x.locus, x.start, x.end) for x in loci.collect()} == {(rank[x[0]], x[1], x[2]) for x in want.values()}
        assert assign.islands(t).agg(F.sum("genes")).first()[0] == n
    with pytest.raises(ValueError, match="total"):
        assign.assigned(t.unionByName(t.limit(1)))


def test_annotations_of_files(spark):
    rows = [
        ("f1", 1, "exon", 1, 9, "ID=early"), ("f1", 2, "gene", 1, 100, "ID=g1;x"), ("f1", 3, "mRNA", 1, 100, "ID=m1;Parent=g1"), ("f1", 4, "CDS", 1, 50, "Parent=m1;ID=c1"), ("f1", 5, "mRNA", 1, 90, "ID=m2;primary=False"), ("f1", 6, "exon", 1, 90, "ID=e2"),
        ("f1", 7, "mRNA", 1, 90, "Parent=g1"), ("f1", 8, "exon", 1, 90, "ID=e3"), ("f1", 9, "intron", 1, 90, "ID=i"), ("f1", 10, "ncRNA_gene", 1, 9, "ID=n"), ("f1", 11, "exon", 1, 9, "ID=e4"), ("f1", 12, "gene", 5, 9, "Name=none"), ("f1", 13, "mRNA", 5, 9, "ID=m4"),
        ("f2", 20, "gene", 40, 100, "ID=h1"), ("f2", 21, "exon", 40, 99, "ID=e5"), ("f2", 22, "gene", 90, 300, "ID=h2"),
    ]
    t = spark.createDataFrame([(f, n, "c", "s", k, a, b, None, "+", None, x) for f, n, k, a, b, x in rows], "file string, line_no long, seqid string, source string, type string, start long, end long, score double, strand string, phase int, attributes string")
    got, loci = assign.annotated(t, ["file"])
    assert sorted((x.line_no, x.gene_id, x.mrna_id, x.feature_id, x.locus, x.score, x.phase) for x in got.collect()) == [
        (1, None, None, "early", None, 0.0, 0), (2, "g1", None, "g1", 1, 0.0, 0), (3, "g1", "m1", "m1", 1, 0.0, 0), (4, "g1", "m1", "c1", 1, 0.0, 0), (8, "g1", "m1", "e3", 1, 0.0, 0),
        (20, "h1", None, "h1", 1, 0.0, 0), (21, "h1", None, "e5", 1, 0.0, 0), (22, "h2", None, "h2", 2, 0.0, 0),
    ]
    assert sorted(map(tuple, loci.select("locus", "start", "end", "genes").collect())) == [(1, 1, 100, 2), (2, 90, 300, 1)]


def complement(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def mend(seq, strand, parts, stops=("TAA", "TAG", "TGA")):
    """One model, on a plus strand (minus strands are mirrored): ``(needed, ok, parts)``."""
    n = len(seq)
    mirror = lambda ps: sorted((n + 1 - b, n + 1 - a, f) for a, b, f in ps)
    s, p = (seq, sorted(parts)) if strand == "+" else (complement(seq), mirror(parts))
    spliced = "".join(s[a - 1 : b] for a, b, _ in p)[p[0][2] :]
    no_start, no_stop = spliced[:3] != "ATG" if len(spliced) >= 3 else True, spliced[-3:] not in stops
    ok = True
    if no_stop:
        a, b, f = p[-1]
        e = b - (b - (a + f) + 1) % 3
        hit = next((k for k in range(e, n - 2, 3) if s[k : k + 3] in stops), None)
        ok = hit is not None
        if ok:
            p = [*p[:-1], (a, hit + 3, f)]
    if no_start:
        a, b, f = p[0]
        hit = next((k for k in range(a + f - 3, 0, -3) if s[k - 1 : k + 2] in stops), None)
        found = None
        if hit is not None:
            q = [(hit, b, 0), *p[1:]]
            text = "".join(s[x - 1 : y] for x, y, _ in q)
            found = next((k for k in range(0, len(text) - 5, 3) if text[k : k + 3] == "ATG"), None)
            if found is not None and any(text[k : k + 3] == "ATG" for k in range(0, found, 3)):
                found = None
        if found is None:
            ok = False
        else:
            p = []
            for x, y, g in q:
                if y - x + 1 > found:
                    p.append((x + found, y, 0 if found else g))
                    found = 0
                else:
                    found -= y - x + 1
    return no_start or no_stop, ok, p if strand == "+" else mirror(p)


def test_ends_are_mended_over_piece_borders(spark):
    r = random.Random(21)
    seqs = {f"s{k}": "".join(r.choice("ACGT" if k % 3 else "ACGTCCCGGG") for _ in range(r.choice((5, 40, 400, 3000)))) for k in range(40)}
    lines, models, cds, want = [], [], [], {}
    for name, s in seqs.items():
        lines.append(f">{name} some words")
        lines += [s[k : k + 37].lower() if k % 2 else s[k : k + 37] for k in range(0, len(s), 37)]
        for m in range(4):
            cuts = sorted(r.sample(range(1, len(s) + 1), min(len(s), r.choice((2, 4, 6))) // 2 * 2))
            parts = [(cuts[k], cuts[k + 1], r.randrange(3)) for k in range(0, len(cuts), 2)]
            strand, mrna = r.choice("+-"), f"{name}.{m}"
            models.append((mrna, name, strand))
            cds += [(mrna, *p) for p in parts]
            want[mrna] = mend(s, strand, parts)
    text = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string").repartition(5)
    for size in (64, 1 << 16):
        store = genome.from_lines(text, size).cache()
        assert {x.seqid: x.length for x in genome.lengths(store, size).collect()} == {k: len(s) for k, s in seqs.items()}
        status, got = ends.mended(spark.createDataFrame(models, "mrna string, seqid string, strand string"), spark.createDataFrame(cds, "mrna string, start long, end long, phase int"), store, window=9, size=size)
        parts = {}
        for x in got.collect():
            parts.setdefault(x.mrna, []).append((x.start, x.end, x.phase))
        for x in status.collect():
            assert (x.needed, x.ok, sorted(parts[x.mrna])) == (want[x.mrna][0], want[x.mrna][1], sorted(want[x.mrna][2])), (size, x)
        assert status.where("needed AND ok").count() > 20 and status.where("NOT ok").count() > 10


def test_exons_follow_coding_parts(spark):
    shape = "mrna string, start long, end long"
    cds = spark.createDataFrame([("a", 10, 20), ("a", 31, 40), ("b", 5, 9), ("c", 5, 9), ("c", 10, 12)], shape)
    exons = spark.createDataFrame([("a", 1, 25), ("a", 29, 60), ("a", 80, 90), ("b", 1, 9), ("d", 3, 4), ("d", 6, 9)], shape)
    x, i = ends.repaired_exons(cds, exons)
    assert sorted(map(tuple, x.collect())) == [("a", 1, 20), ("a", 31, 60), ("a", 80, 90), ("b", 1, 9), ("c", 5, 12), ("d", 3, 4), ("d", 6, 9)]
    assert sorted(map(tuple, i.collect())) == [("a", 21, 30), ("a", 61, 79), ("d", 5, 5)]


def test_closure_of_any_depth(spark):
    shape = "line_no long, seqid string, type string, start long, end long, id string, parents array<string>"
    up = {"r": [], "a": ["r"], "b": ["a"], "c": ["b"], "d": ["c", "x"], "e": ["d"], "o": ["lost"], "p": ["o"], "x": [], "y": ["x"], "u": ["v"], "v": ["u"], "w": ["u"]}
    rows = [(n, "s", "t", 1, 2, i, p or None) for n, (i, p) in enumerate(up.items())] + [(50, "s", "t", 1, 2, None, ["c"]), (51, "s", "t", 1, 2, None, None)]
    t = spark.createDataFrame(rows, shape)
    got = {x.line_no: (x.root, x.depth, x.orphan) for x in tree.closure(t).collect()}
    lines = {i: n for n, i in enumerate(up)}
    want = {"r": ("r", 0, False), "a": ("r", 1, False), "b": ("r", 2, False), "c": ("r", 3, False), "d": ("r", 4, False), "e": ("r", 5, False), "o": ("o", 0, True), "p": ("o", 1, False), "x": ("x", 0, False), "y": ("x", 1, False), **dict.fromkeys("uvw", (None, None, False))}
    assert got == {lines[i]: v for i, v in want.items()} | {50: ("r", 4, False), 51: (None, 0, False)}
    left = lambda *ids: {x.id or x.line_no for x in tree.without_below(t, spark.createDataFrame([(i,) for i in ids], "id string")).collect()}
    assert left("a") == {*up, 51} - {"a", "b", "c"}  # d has another parent
    assert left("a", "x") == {*up, 51} - {"a", "b", "c", "d", "e", "x", "y"}
    assert left("u") == {*up, 50, 51} - {"u", "v", "w"}
    f = spark.createDataFrame([(1, "s", "gene", 1, 9, "g", None), (2, "s", "lnc_RNA", 1, 9, "t", ["g"]), (3, "s", "exon", 1, 9, "x", ["t", "q"]), (4, "s", "gene", 1, 9, "h", None), (5, "s", "CDS", 1, 9, None, ["h"]), (6, "s", "mRNA", 1, 9, "q", ["h"])], shape)
    assert sorted((x.line_no, x.gene, x.transcript) for x in gff3.gene_content(f).collect()) == [(2, "g", "t"), (3, "g", "t"), (3, "h", "q"), (6, "h", "q")]
    assert [x.block for x in gff3.gene_blocks(f).orderBy("line_no").collect()] == [1, 1, 1, 2, 2, 2]


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(60), r.randrange(50)) for _ in range(70)] + [(100 + k, 1000 + k + d) for k in range(30) for d in (0, 1)]
    group = {n: n for n, _ in links}
    for _ in links:
        for n, k in links:
            low = min(group[m] for m, j in links if j == k)
            group[n] = min(group[n], low)
    got = chains.components(spark.createDataFrame(links, "node int, key int")).collect()
    assert {x.node: x.component for x in got} == group


def test_region_clusters_by_the_row_before(spark):
    r = random.Random(12)
    rows = list({(r.choice("xy"), s := r.randrange(9000), s + r.choice((5, 50, 3000)), r.choice("+-"), r.choice("pqr")) for _ in range(150)})
    t = spark.createDataFrame(rows, "chrom string, start long, end long, strand string, prot string")
    genes = spark.createDataFrame([("p", "g"), ("q", "g")], "transcript_id string, gene_id string")
    of = {"p": "g", "q": "g", "r": "r"}
    groups, k, before = collections.defaultdict(list), 0, None
    for c, g, s, e, p, st in sorted((c, of[p], s, e, p, st) for c, s, e, st, p in rows):
        if before is None or before[:2] != (c, g) or abs(s - before[2]) > 60:
            k += 1
        before = (c, g, e)
        groups[c, g, st, k].append((s, e, p))
    want = sorted((c, g, st, ", ".join(sorted({x[2] for x in v})), min(x[0] for x in v), max(x[1] for x in v)) for (c, g, st, _), v in groups.items())
    got = scoring.region_clusters(t, genes, 60, parity=True)
    assert sorted(map(tuple, got.select("chrom", "gene", "strand", "proteins", "start", "end").collect())) == want
    joined, k, before = collections.defaultdict(list), 0, None
    for c, s, e, g, st, _ in sorted((c, s, e, g, st, p) for c, g, st, p, s, e in want):
        if before is None or before[0] != c or s > before[1]:
            k += 1
        before = (c, e)
        joined[c, st, k].append((s, e, g))
    want = sorted((c, st, ", ".join(sorted({x[2] for x in v})), min(x[0] for x in v), max(x[1] for x in v)) for (c, st, _), v in joined.items())
    assert sorted(map(tuple, scoring.overlapping_regions(got, parity=True).select("chrom", "strand", "genes", "start", "end").collect())) == want


GFF = "line_no long, seqid string, source string, type string, start long, end long, score double, strand string, phase int, attributes string"


def gff_rows(models):
    """``models``: gene, start, end, {mRNA: (start, end)}; each mRNA has a CDS, and the gene an exon of all its mRNAs."""
    out = []
    for gene, start, end, mrnas in models:
        out.append(("gene", start, end, f"ID={gene};Name=x"))
        for m, (s, e) in mrnas.items():
            out += [("mRNA", s, e, f"ID={m};Parent={gene}"), ("CDS", s, e, f"ID=c.{m};Parent={m}")]
        out.append(("exon", start, end, f"ID=e.{gene};Parent={','.join(mrnas)};"))
    return [(10 * n + 5, "c", "s", k, s, e, None, "+", None, a) for n, (k, s, e, a) in enumerate(out)]


def merge_in_turn(a, b, decisions):
    """The merged set, block after block: (type, attributes) of its rows."""
    def cut(rows):
        out = []
        for x in rows:
            if x[3] == "gene":
                out.append([])
            out[-1].append(x)
        return {re.search("ID=([^;]+)", y[0][9])[1]: y for y in out}

    a, b, out, taken = cut(a), cut(b), [], set()

    def emit(block, fixed):
        ids = {m[1] for x in block if (m := re.search("ID=([^;]+)", x[9]))}
        end, k = "", 0
        while not fixed and any(i + end in taken for i in ids):
            k += 1
            end = ".rescued" + (str(k) if k > 1 else "")
        taken.update(i + end for i in ids)
        for x in block:
            text = re.sub("ID=([^;]+)", lambda m: f"ID={m[1]}{end}", x[9])
            text = re.sub("Parent=([^;]+)", lambda m: "Parent=" + ",".join(p + end if p in ids else p for p in m[1].split(",")), text)
            out.append((x[3], text))

    for name, block in b.items():
        winners = [g for g in a if decisions[g] == ("replaces", name)]
        if not winners:
            emit(block, True)
        for g in winners:
            lo, hi = a[g][0][4], a[g][0][5]
            moved, inside = [], False
            names = {re.search("ID=([^;]+)", x[9])[1] for x in block if x[3] == "mRNA" and x[4] >= lo and x[5] <= hi}
            for x in block[1:]:
                if x[3] == "mRNA":
                    inside = x[4] >= lo and x[5] <= hi
                    text = re.sub("Parent=[^;]+", f"Parent={g}", re.sub("ID=([^;]+)", r"ID=\1_pasa_iso", x[9]))
                else:
                    text = re.sub("Parent=([^;]+)", lambda m: "Parent=" + ",".join(p + "_pasa_iso" for p in m[1].split(",") if p in names), x[9])
                if inside:
                    moved.append((*x[:9], text))
            emit(a[g] + moved, False)
    for g, block in a.items():
        if decisions[g][0] == "rescued":
            emit(block, False)
    return out


def test_merged_set_as_rows(spark):
    r = random.Random(7)
    b_models = [(f"g{k}", 100 * k, 100 * k + 90, {f"g{k}.t{j}": (100 * k + 5 * j, 100 * k + 90 - 9 * j) for j in range(3)}) for k in range(40)]
    # genes that are named as others will be
    a_models = [(f"g{n}.rescued", 1, 2, {f"g{n}.rescued.t0": (1, 2)}) for n in (1, 2, 4)]
    decisions = {m[0]: ("rescued", None) for m in a_models}
    for n in r.sample(range(60), 60):
        gene, where = (f"g{n}" if n % 3 else f"a{n}"), r.randrange(5, 40)
        a_models.append((gene, 100 * where, 100 * where + r.choice((60, 95)), {f"{gene}.t{j}": (100 * where, 100 * where + 50) for j in range(r.choice((1, 2)))}))
        decisions[gene] = r.choice((("replaces", f"g{where}"), ("rescued", None), ("same", f"g{where}")))
    decisions |= {f"g{n}": ("rescued", None) for n in (1, 2, 4)}
    a, b = gff_rows(a_models), gff_rows(b_models)
    d = spark.createDataFrame([(g, p, s) for g, (s, p) in decisions.items()], "gene string, partner string, status string")
    got = modelset.merged(spark.createDataFrame(a, GFF).repartition(4), spark.createDataFrame(b, GFF).repartition(4), d)
    rows = [(x.type, x.attributes) for x in got.orderBy("section", "slot", "block", "part", "line_no").collect()]
    want = merge_in_turn(a, b, decisions)
    assert rows == want
    assert sum(".rescued2" in x for _, x in want) and sum("_pasa_iso" in x for _, x in want)
    assert modelset.unresolved(got).count() == 0
    ids = [m[1] for _, x in want if (m := re.search("ID=([^;]+)", x))]
    twice = {i for i, n in collections.Counter(ids).items() if n > 1}
    kept = {m[1] for x in b if (m := re.search("ID=([^;]+)", x[9]))}
    assert twice <= kept  # only a gene that keeps its place can meet a name that was given before it


def test_kept_and_discarded(spark):
    rows = gff_rows([("g1", 1, 90, {"g1.t1": (1, 9), "g1.t2": (2, 8)}), ("g2", 5, 9, {"g2.t1": (5, 9), "g2.t2": (5, 8)}), ("g3", 5, 9, {"g3": (5, 9)}), ("g4", 1, 2, {"g4.t1": (1, 2)})])
    f = spark.createDataFrame(rows, GFF)
    ids = spark.createDataFrame([("o1", "g1.t1"), ("o2", "g1.t2"), ("o3", "g2.t1"), ("o4", "g2.t2"), ("o5", "g3")], "transcript_id string, new_id string")
    kept, gone = modelset.kept_and_discarded(f, ids, spark.createDataFrame([("o1",)], "transcript_id string"), spark.createDataFrame([("o2", "lncRNA"), ("o3", "pseudogene_retrocopy"), ("o4", "TE_related"), ("o5", "odd")], "transcript_id string, reason string"))
    assert {x.attributes for x in kept.collect()} == {"ID=g1;Name=x", "ID=g1.t1;Parent=g1", "ID=c.g1.t1;Parent=g1.t1", "ID=g1.t2;Parent=g1", "ID=e.g1;Parent=g1.t1,g1.t2;"}
    assert {x.attributes for x in gone.collect()} == {
        "ID=c.g1.t2;Parent=g1.t2;discard_reason=lncRNA", "ID=g2;Name=x;discard_reason=TE_related", "ID=g2.t1;Parent=g2;discard_reason=pseudogene_retrocopy", "ID=c.g2.t1;Parent=g2.t1;discard_reason=pseudogene_retrocopy", "ID=g2.t2;Parent=g2;discard_reason=TE_related",
        "ID=c.g2.t2;Parent=g2.t2;discard_reason=TE_related", "ID=e.g2;Parent=g2.t1,g2.t2;discard_reason=pseudogene", "ID=g3;Name=x;discard_reason=odd", "ID=g3;Parent=g3;discard_reason=odd", "ID=c.g3;Parent=g3;discard_reason=odd", "ID=e.g3;Parent=g3;discard_reason=odd",
        "ID=g4;Name=x;discard_reason=pseudogene", "ID=g4.t1;Parent=g4;discard_reason=pseudogene", "ID=c.g4.t1;Parent=g4.t1;discard_reason=pseudogene", "ID=e.g4;Parent=g4.t1;discard_reason=pseudogene",
    }


def test_out_of_bag_votes_are_those_of_unseen_trees(spark):
    r = random.Random(9)
    data = [(f"t{k}", x := r.random(), r.random(), float(x + r.gauss(0, 0.2) > 0.5)) for k in range(120)]
    t = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(spark.createDataFrame(data, "transcript_id string, a double, b double, y double")).select("transcript_id", "x", "y")
    t = written(t, "rows")
    models = bagging.bag(t, 6, 1, 5)
    drawn = {(x.transcript_id, k): x[f"d{k}"] for x in t.select("transcript_id", *(bagging.draws(F.col("transcript_id"), k, 5).alias(f"d{k}") for k in range(6))).collect() for k in range(6)}
    assert 0.8 < sum(drawn.values()) / len(drawn) < 1.2 and 0.3 < sum(v == 0 for v in drawn.values()) / len(drawn) < 0.45
    votes = collections.defaultdict(list)
    for k, m in enumerate(models):
        for x in m.transform(t).collect():
            if drawn[x.transcript_id, k] == 0:
                votes[x.transcript_id].append(x.probability[1])
    got = bagging.out_of_bag(t, models, 5, together=4)
    for x in got.collect():
        mine = votes[x.transcript_id]
        assert x.unseen == len(mine) and (x.p is None if not mine else abs(x.p - sum(mine) / len(mine)) < 1e-9)
    y = {d[0]: d[3] for d in data}
    wrong = [(sum(v) / len(v) > 0.5) != (y[i] == 1) for i, v in votes.items() if v]
    assert abs(bagging.error(got) - sum(wrong) / len(wrong)) < 1e-12 and bagging.error(got) < 0.35
    assert bagging.error(bagging.out_of_bag(t, [None], 5)) is None


def test_untranslated_pieces_and_numbers(spark):
    shape = "mrna string, start long, end long"
    models = spark.createDataFrame([("p", "s", "+"), ("m", "s", "-")], "mrna string, seqid string, strand string")
    cds = spark.createDataFrame([(m, *x) for m in "pm" for x in ((20, 30), (41, 50))], shape)
    exons = spark.createDataFrame([(m, *x) for m in "pm" for x in ((1, 5), (10, 30), (41, 60), (70, 80))], shape)
    u = ends.outside(cds, exons, models)
    left, right = [(1, 5), (10, 19)], [(51, 60), (70, 80)]
    want = {("p", "five_prime_UTR", *x) for x in left} | {("p", "three_prime_UTR", *x) for x in right} | {("m", "three_prime_UTR", *x) for x in left} | {("m", "five_prime_UTR", *x) for x in right}
    assert set(map(tuple, u.collect())) == want
    parts = u.unionByName(cds.withColumn("type", F.lit("CDS")))
    known = spark.createDataFrame([("p", "s", "+", "CDS", 20, 30, 0.5, "ID=q; Note=a ;Parent=p", 1), ("p", "s", "+", "CDS", 20, 30, 0.7, "iD=q; Note=b ;", 2), ("m", "s", "+", "CDS", 20, 30, 0.9, "Note=c", 3)], "mrna string, seqid string, strand string, type string, start long, end long, score double, attributes string, line_no long")
    got = [(x.mrna, x.start, x.score, x.attributes) for x in ends.numbered(models, parts, known).orderBy("mrna", "place").collect()]
    assert got == [
        ("m", 70, None, "ID=m.utr5p2;Parent=m;"), ("m", 51, None, "ID=m.utr5p1;Parent=m;"), ("m", 41, None, "ID=m.CDS1;Parent=m;"), ("m", 20, None, "ID=m.CDS2;Parent=m;"), ("m", 10, None, "ID=m.utr3p2;Parent=m;"), ("m", 1, None, "ID=m.utr3p1;Parent=m;"),
        ("p", 1, None, "ID=p.utr5p1;Parent=p;"), ("p", 10, None, "ID=p.utr5p2;Parent=p;"), ("p", 20, 0.7, "ID=p.CDS1;Parent=p;Note=b;"), ("p", 41, None, "ID=p.CDS2;Parent=p;"), ("p", 51, None, "ID=p.utr3p1;Parent=p;"), ("p", 70, None, "ID=p.utr3p2;Parent=p;"),
    ]


def test_files_of_alignments_and_summaries(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/x.gff3").write_text("##gff-version 3\ns\tm\tmRNA\t5\t90\t7\t+\t.\tID=M1;Rank=2;Identity=0.9;Target=P1 1 30\ns\tm\tCDS\t5\t30\t.\t+\t0\tParent=M1\ns\tm\tCDS\t61\t90\t.\t+\t0\tParent=M1\ns\tm\tmRNA\t7\t9\t.\t-\t.\tID=M2\n")
    (tmp_path / "a/b/y.GFF3").write_text("#\n")
    (tmp_path / "a/b/z.sum").write_text("#The selected clade was x\nA:92.10%[S:1],I:1.43%[p],C:0.25%[q],U:6.47%\nA:93%[S:1],I:1.5%[p],C:0.5%[q],U:3.56%\n")
    (tmp_path / "a/b/w.sum").write_text("A:1%,I:1%,C:1%,U:1%\n")
    for name in ("d/r1_1.fq.gz", "d/e/r1_2.fq.gz", "d/e/q.fastq"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("@\n")
    assert {x.sample: (x.one is None, x.single is None) for x in tables.find_reads(spark, str(tmp_path / "d")).collect()} == {"r1": (False, True), "q": (True, False)}
    (tmp_path / "t.tsv").write_text("a\t1\t2.5\nb\t2\t3\n")
    assert tables.read_plain(spark, str(tmp_path / "t.tsv")).dtypes == [("column0", "string"), ("column1", "int"), ("column2", "double")]
    assert sorted(x.path.rsplit("/", 1)[1] for x in tables.listed(spark, str(tmp_path / "a"), [".gff3"]).collect()) == ["x.gff3", "y.GFF3"]
    got = {x.file[-5:]: tuple(x)[1:] for x in tables.read_omark(spark, str(tmp_path / "a/b/*.sum")).collect()}
    assert got == {"z.sum": ("93", "0.5", "3.56"), "w.sum": ("N/A",) * 3}
    f = gff3.read_gff3(spark, str(tmp_path / "a/x.gff3"))
    m = {x.mrna: x for x in gff3.miniprot_models(f).collect()}
    assert (m["M1"].gene, m["M1"].target, m["M1"].identity, m["M1"].rank, [tuple(p) for p in m["M1"].cds]) == ("M1_gene", "P1", 0.9, 2, [(5, 30), (61, 90)])
    assert (m["M2"].identity, m["M2"].rank, m["M2"].cds) == (0.0, 1, None)
    rows = gff3.with_gene_rows(f).orderBy("line_no").collect()
    assert [(x.type, x.id, x.parents) for x in rows] == [("gene", "M1_gene", None), ("mRNA", "M1", ["M1_gene"]), ("CDS", None, ["M1"]), ("CDS", None, ["M1"]), ("gene", "M2_gene", None), ("mRNA", "M2", ["M2_gene"])]
    at = spark.createDataFrame([("s", p) for p in (5, 6, 30, 31, 62)], "seqid string, position long")
    assert [x.d for x in gff3.with_depth(at, gff3.protein_depth(f), "d").orderBy("position").collect()] == [0, 1, 1, 0, 1]


def test_rows_of_one_line_number_have_one_order(spark):
    rows = [(7, "Chr1", "s", "gene", 1, 90, "+", "g", None), (8, "Chr1", "s", "mRNA", 1, 90, "+", "m", ["g"]), *((9, "Chr1", "s", "CDS", a, a + 3, "+", "c", ["m"]) for a in (40, 10, 30, 20))]
    shape = "line_no long, seqid string, source string, type string, start long, end long, strand string, id string, parents array<string>"
    seen = set()
    for k in range(3):
        t = tree.renumbered(tree.linked(spark.createDataFrame(rows[k:] + rows[:k], shape).repartition(k + 1)), "A")
        seen.add(tuple(sorted((x.start, x.id, x.new_id) for x in t.where("type = 'CDS'").collect())))
    assert len(seen) == 1 and [x[1:] for x in seen.pop()] == [("c", "A1G0000010.t1.cds1"), ("c_2", "A1G0000010.t1.cds2"), ("c_3", "A1G0000010.t1.cds3"), ("c_4", "A1G0000010.t1.cds4")]


def test_sets_and_attributes(spark):
    t = spark.createDataFrame([(1, "AA"), (2, "B"), (3, "AA"), (4, None), (5, None)], "n int, s string")
    assert sorted(x.n for x in sets.first_of_equal_texts(t, "s", "n").collect()) == [1, 2, 4]
    a = spark.createDataFrame([("ID=x;K=1;L=2",), ("K=1",), ("ID=x;",), (".",), (None,)], "a string")
    assert [x.v for x in a.select(set_attribute("a", "K", F.lit("9")).alias("v")).collect()] == ["ID=x;K=9;L=2", "K=9", "ID=x;K=9", "K=9", "K=9"]
    p = sets.placed(spark.createDataFrame([("a", 5, 1), ("a", 3, 2), ("a", 900, 3), ("b", 1, 4)], "k string, s long, n long"), ["k"], "s", "n", size=10)
    assert {x.n: x.place for x in p.collect()} == {2: 1, 1: 2, 3: 3, 4: 1}
