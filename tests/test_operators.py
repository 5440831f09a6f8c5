"""Golden vectors and invariants of the tree, tiling, scoring, merging, classifier and source operators."""

import random

import pytest
from pyspark.sql import functions as F

from locusloom.functions import sequences as sq
from locusloom.ml import filtering
from locusloom.operators import evidence as ev
from locusloom.operators import chains, loci, scoring, tiling, tree
from locusloom.operators.sweep import measure
from locusloom.sources import gff3, tables

GFF = "line_no long, seqid string, source string, type string, start long, end long, strand string, id string, parents array<string>"


def rows(spark, *lines):
    return spark.createDataFrame([(n, "c", "s", t, s, e, "+", i, p) for n, (t, s, e, i, p) in enumerate(lines)], GFF)


def test_measure_against_brute_force(spark):
    r = random.Random(3)
    a = [(r.choice("xy"), s := r.randrange(300), s + r.randrange(0, 60), i) for i in range(80)]
    b = [(r.choice("xy"), s := r.randrange(300), s + r.randrange(0, 60)) for _ in range(80)]
    da, db = spark.createDataFrame(a, "chrom string, start long, end long, i int"), spark.createDataFrame(b, "chrom string, b_start long, b_end long")
    for size in (16, 4096):
        for x in measure(da, db, size=size).collect():
            met = [y for y in b if y[0] == x.chrom and y[1] < y[2] and max(x.start, y[1]) < min(x.end, y[2])]
            inside = [set(range(max(x.start, y[1]), min(x.end, y[2]))) for y in met]
            n = len([y for y in b if y[0] == x.chrom and y[1] < y[2] and y[1] < x.end and y[2] > x.start]) if x.end > x.start else 0
            assert (x.n_overlaps, x.bp_covered, x.bp_shared) == (n, len(set().union(*inside)), sum(map(len, inside)))


def test_runs_clusters_and_gaps_across_ranges(spark):
    r = random.Random(5)
    t = [("c", s := r.randrange(400), s + r.randrange(1, 30)) for _ in range(40)]
    d = spark.createDataFrame(t, "chrom string, start long, end long")
    whole = [tuple(x) for x in loci.depth_runs(d, ["chrom"]).select("start", "end", "depth").collect()]
    assert sorted(tuple(x) for x in loci.depth_runs(d, ["chrom"], size=8).select("start", "end", "depth").collect()) == sorted(whole)
    for s, e, n in whole:
        assert all(sum(x[1] <= p < x[2] for x in t) == n for p in range(s, e))
    assert sorted(x.cluster for x in loci.clusters(d, ["chrom"], size=8).collect()) == sorted(x.cluster for x in loci.clusters(d, ["chrom"]).collect())
    lengths = spark.createDataFrame([("c", 500), ("d", 70)], "chrom string, length long")
    covered = {p for _, s, e in t for p in range(s, e + 1)}
    got = {p for x in loci.gaps(d, ["chrom"], 1, lengths, size=8).where("chrom = 'c'").collect() for p in range(x.gap_start, x.gap_end + 1)}
    assert got == set(range(1, 501)) - covered
    assert [(x.gap_start, x.gap_end) for x in loci.gaps(d, ["chrom"], 50, lengths).where("chrom = 'd'").collect()] == [(1, 70)]


def tile(spark, length, span, gaps=(), profile=None, width=10, reach=30):
    g = spark.createDataFrame([("s", a, b) for a, b in gaps], "seqid string, gap_start long, gap_end long")
    p = None if profile is None else spark.createDataFrame([("s", i, d) for i, d in enumerate(profile)], "seqid string, bin long, depth long")
    t = tiling.tiles(spark.createDataFrame([("s", length)], "seqid string, length long"), g, p, span, width, reach)
    return [(x.start, x.end) for x in t.orderBy("tile").collect()]


def test_tiles(spark):
    assert tile(spark, 10, 10) == [(1, 10)]
    assert tile(spark, 10, 4) == [(1, 4), (5, 8), (9, 10)]
    assert tile(spark, 10, 4, [(3, 3)]) == [(1, 3), (4, 7), (8, 10)]
    assert tile(spark, 100, 40, [(30, 60)]) == [(1, 40), (41, 60), (61, 100)]
    assert tile(spark, 100, 50, profile=[9, 9, 9, 1, 9, 9, 9, 9, 9, 9]) == [(1, 36), (37, 86), (87, 100)]
    assert tile(spark, 60, 50, profile=[5] * 6)[0] == (1, 46)
    with pytest.raises(ValueError):
        tile(spark, 10, 0)
    assert tile(spark, 5_000_000, 5_000_000) == [(1, 5_000_000)] and tile(spark, 0, 5) == []
    assert tile(spark, 12_827_620, 5_000_000) == [(1, 5_000_000), (5_000_001, 10_000_000), (10_000_001, 12_827_620)]
    assert tile(spark, 12_827_620, 5_000_000, [(3_000_000, 3_001_000), (4_800_000, 4_802_000)])[0] == (1, 4_802_000)
    assert tile(spark, 9_000_000, 5_000_000, [(4_990_000, 5_010_000)])[0] == (1, 5_000_000)


def one_by_one(length, gaps, depth, span, width, reach):
    """Tiles of one sequence by the rule as it is said, base by base."""
    bare = {p for a, b in gaps for p in range(a, b + 1)}
    out, at = [], 1
    while length - at >= span:
        limit = at + span - 1
        free = [p for p in range(at, limit + 1) if p in bare]
        near = [b for b in depth if max(at, limit - reach + 1) <= (b + 1) * width and b * width + 1 <= limit]
        if free:
            end = free[-1]
        elif near:
            end = min(max(min(near, key=lambda b: (depth[b], -b)) * width + width // 2 + 1, at), limit)
        else:
            end = limit
        out.append((at, end))
        at = end + 1
    return [*out, (at, length)]


def test_tiles_of_many_sequences_against_the_rule(spark):
    r = random.Random(8)
    lengths, gaps, depth, want = [], [], [], {}
    for k in range(25):
        name, length = f"s{k}", r.randrange(1, 900)
        mine = [(a, min(length, a + r.randrange(0, r.choice((3, 60, 200))))) for a in r.sample(range(1, length + 1), min(length, r.choice((0, 2, 9))))]
        d = {b: r.randrange(4) for b in range(length // 10 + 1) if r.random() < 0.8}
        lengths.append((name, length))
        gaps += [(name, *g) for g in mine]
        depth += [(name, b, v) for b, v in d.items()]
        want[name] = one_by_one(length, mine, d, 45, 10, 30)
    t = tiling.tiles(spark.createDataFrame(lengths, "seqid string, length long"), spark.createDataFrame(gaps, "seqid string, gap_start long, gap_end long"), spark.createDataFrame(depth, "seqid string, bin long, depth long"), 45, 10, 30)
    got = {}
    for x in t.orderBy("seqid", "tile").collect():
        got.setdefault(x.seqid, []).append((x.start, x.end))
    assert got == want


def test_cuts_against_the_rule(spark):
    r = random.Random(2)
    for lo, hi, width, span, share in ((0, 100, 50, 10, 0.25), (0, 1000, 20, 90, 0.25), (7, 450, 30, 40, 0.9), (0, 50, 5, 100, 0.25)):
        reads = [r.randrange(lo, hi) for _ in range(60)]
        bounds = spark.createDataFrame([("s", lo, hi)], "seqid string, lo long, hi long")
        n = {}
        for p in reads:
            n[(p - lo) // width] = n.get((p - lo) // width, 0) + 1
        parts, want = -(-(hi - lo) // span), []
        for k in range(1, parts):
            ideal, away = lo + int((hi - lo) / parts * k), int((hi - lo) / parts * share)
            a, b = (max(lo + 1, ideal - away) - lo) // width, (min(hi - 1, ideal + away) - lo) // width
            c = ideal if b <= a else lo + width // 2 + width * min(range(a, b + 1), key=lambda x: (n.get(x, 0), abs(lo + x * width - ideal)))
            want.append(min(hi - 1, want[-1] + width if want and c <= want[-1] else c))
        got = tiling.cuts(bounds, tiling.start_bins(spark.createDataFrame([("s", p) for p in reads], "seqid string, pos long"), bounds, width), width, span, share)
        assert [x.cut for x in got.orderBy("k").collect()] == want
    assert want == []


def test_evidence_in_segments_and_back(spark):
    r = random.Random(6)
    lengths = spark.createDataFrame([("a", 1000), ("b", 37)], "seqid string, length long")
    ev_rows = [(s, a := r.randrange(1, n + 1), min(n, a + r.randrange(0, 300)), i) for i in range(60) for s, n in (("a", 1000), ("b", 37))]
    e = spark.createDataFrame(ev_rows, "seqid string, start long, end long, n int")
    pieces = tiling.segments(lengths, 200, 60)
    parts = tiling.dealt(e, pieces, 128)
    want = sum(min(x[2], p.end) >= max(x[1], p.start) for x in ev_rows for p in pieces.collect() if p.seqid == x[0])
    assert parts.count() == want and parts.where("start < 1 OR end > 200 OR end < start").count() == 0
    back = {}
    for x in tiling.taken_back(parts, pieces).collect():
        for p in range(x.start, x.end + 1):
            back[x.seqid, p] = back.get((x.seqid, p), 0) + 1
    depth = {}
    for s, a, b, _ in ev_rows:
        for p in range(a, b + 1):
            depth[s, p] = depth.get((s, p), 0) + 1
    assert back == depth


def test_paths_and_roots(spark):
    links = spark.createDataFrame([("x", 1, 3), ("x", 3, 8), ("x", 8, 9), ("x", 9, None), ("x", 2, 3), ("y", 1, None)], "k string, at long, to long")
    start = spark.createDataFrame([("x", 1), ("y", 1)], "k string, at long")
    assert sorted(map(tuple, chains.followed(start, links, ["k"]).collect())) == [("x", 1), ("x", 3), ("x", 8), ("x", 9), ("y", 1)]
    up = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("o", "lost"), ("p", "o"), ("u", "v"), ("v", "w"), ("w", "u"), ("z", "u"), ("self", "self")]
    got = {x.id: (x.root, x.depth) for x in chains.rooted(spark.createDataFrame(up, "id string, parent string")).collect()}
    assert got == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("a", 3), "e": ("a", 4), "o": ("o", 0), "p": ("o", 1), **dict.fromkeys(("u", "v", "w", "z", "self"), (None, None))}


def test_bins_cuts_and_routes(spark):
    lengths = spark.createDataFrame([("a", 100), ("b", 90), ("c", 40), ("d", 30), ("e", 25), ("f", 60)], "seqid string, length long")
    got = {x.seqid: x.bin for x in tiling.coarse_bins(lengths, 80).collect()}
    assert got == {"a": "a", "b": "b", "f": "small_0", "c": "small_1", "d": "small_1", "e": "small_2"}
    assert {x.bin for x in tiling.coarse_bins(lengths, 500).collect()} == {"all"}
    reads = spark.createDataFrame([("s", p) for p in range(0, 1000, 10) if not 480 <= p < 530], "seqid string, pos long")
    bounds = spark.createDataFrame([("s", 0, 1000)], "seqid string, lo long, hi long")
    cut = [x.cut for x in tiling.cuts(bounds, tiling.start_bins(reads, bounds, 20), 20, 500).collect()]
    assert cut == [510]
    pieces = spark.createDataFrame([("s", 0, 0, 510), ("s", 1, 510, 900)], "seqid string, piece int, lo long, hi long")
    assert {x.piece: x.n for x in tiling.routed(reads, pieces).groupBy("piece").agg(F.count("pos").alias("n")).collect()} == {0: 48, 1: 47}


def test_cascades(spark):
    t = rows(spark, ("gene", 1, 90, "g1", None), ("mRNA", 1, 90, "m1", ["g1"]), ("exon", 1, 90, "e1", ["m1", "m2"]), ("mRNA", 1, 90, "m2", ["g1"]), ("gene", 5, 9, "g2", None), ("mRNA", 5, 9, "m3", ["g2"]), ("five_prime_UTR", 5, 6, "u", ["m3"]))
    assert {r.mrna for r in tree.childless(t).collect()} == {"m3"} and tree.childless(t, any_child=True).count() == 0
    assert {r.id for r in tree.without_mrnas(t, tree.childless(t)).collect()} == {"g1", "m1", "m2", "e1"}
    bad = spark.createDataFrame([("m1",)], "mrna string")
    assert {r.id for r in tree.without_mrnas(t, bad).collect()} == {"g1", "m2", "e1", "g2", "m3", "u"}
    tree.assert_strands(t)
    with pytest.raises(ValueError):
        tree.assert_strands(t.withColumn("strand", F.when(F.col("id") == "e1", "-").otherwise(F.col("strand"))))
    assert {r.id for r in tree.beyond_end(t, spark.createDataFrame([("c", 50)], "seqid string, length long")).collect()} == {"g2", "m3", "u"}


def test_tree_rules(spark):
    t = rows(spark, ("superlocus", 1, 9, "s", None), ("gene", 1, 90, "g1", None), ("mRNA", 1, 90, "m1", ["g1"]), ("CDS", 1, 5, "c", ["m1"]), ("CDS", 7, 9, "c", ["m1"]), ("ncRNA_gene", 1, 9, "n", None), ("exon", 1, 2, "x", ["m1"]), ("mRNA", 2, 3, "m9", ["lost"]), ("gene", 3, 4, "g2", None), ("exon", 3, 4, "y", ["nowhere"]))
    assert {(r.id, r.gene, r.mrna) for r in tree.linked(t).collect()} == {("g1", "g1", None), ("m1", "g1", "m1"), ("c", "g1", "m1"), ("c_2", "g1", "m1"), ("m9", None, "m9"), ("g2", "g2", None)}
    names = {r.id: r.new_id for r in tree.renumbered(tree.linked(t.withColumn("seqid", F.lit("Chr3"))), "Ab", width=4, digits=2).collect()}
    assert names["g1"] == "Ab03G00010" and names["m1"] == "Ab03G00010.t1" and names["c_2"] == "Ab03G00010.t1.cds2" and names["g2"] == "Ab03G00020"


def test_rule_order_and_rescue(spark):
    t = spark.createDataFrame([(0.0, 0.1, None, 80.0, 3, True, 4, False), (0.0, 0.1, None, 80.0, 0, True, 4, False), (0.0, 0.1, None, 80.0, 0, False, 4, False), (0.0, 0.1, None, 80.0, 3, True, 4, True)], "tpm double, coverage double, pfam boolean, blast_pident double, frameshifts int, single_exon boolean, subject_exons int, protected boolean")
    assert [r.reason for r in ev.pseudogene_reason(t).collect()] == ["B", "C", "A", None]
    r = spark.createDataFrame([(0.9, 50.0, None, None, None, False), (0.9, 50.0, 20.0, None, None, False), (0.6, 0.0, None, True, 0.5, False), (0.1, 0.0, None, None, None, True)], "prob double, rex_pident double, blast_pident double, pfam boolean, repeat double, busco boolean")
    assert [x[0] for x in r.select(ev.rescue_tier()).collect()] == ["none", "classifier", "domain", "busco"]


def test_quantiles_and_curves(spark):
    t = spark.createDataFrame([(float(x),) for x in (0, 10, 20)], "v double")
    q = ev.quantile_cutoffs(t, "v").first()
    assert (round(q.p_low, 9), round(q.p_high, 9)) == (1.0, 19.0)
    assert ev.quantile_cutoffs(t.where("v = 0"), "v", floor_low=0.05, floor_high=1.0).first() == (0.05, 1.0)
    c = ev.curve_summary(spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "score double, label int")).first()
    assert (round(c.roc_auc, 6), round(c.average_precision, 6), round(c.f1, 6), c.threshold) == (0.75, 0.833333, 0.8, 0.7)


@pytest.fixture(scope="module")
def transcripts(spark):
    r = random.Random(6)
    out = []
    for i in range(160):
        good = i % 2 == 0
        x = r.gauss(5 if good else 1, 0.7)
        out.append((i, x, r.random(), None if i % 9 == 0 else x / 6, "Keep" if good and i < 60 else "Discard" if i < 60 else "None", 0.0, 0.0, False, 0.1))
    return spark.createDataFrame(out, "transcript_id int, tpm double, noise double, coverage double, label string, rex_pident double, blast_pident double, pfam boolean, repeat double").repartition(2).cache()


def test_semi_supervised_forest(spark, transcripts):
    busco = spark.createDataFrame([(1, "Complete"), (3, "Missing"), (5, "Fragmented")], "transcript_id int, status string")
    run = lambda **k: filtering.semi_supervised(transcripts, ["tpm", "noise", "coverage"], busco, trees=10, per_split=2, max_iter=3, **k)
    kept, process = run(recycle=0.85)
    got = {r.transcript_id: r.reason for r in kept.collect()}
    assert {i for i in range(0, 60, 2)} <= set(got) and got[1] == "conserved" and 3 not in got and 5 not in got
    assert sum(i in got for i in range(60, 160, 2)) > 45 and sum(i in got for i in range(61, 160, 2)) < 5
    rounds = process.orderBy("round").collect()
    assert rounds[0].keep == 30 and rounds[0].discard == 30 and rounds[0].undecided == 100 and rounds[0].error < 0.1 and rounds[0].busco_discard == 2
    assert all(a.undecided >= b.undecided for a, b in zip(rounds, rounds[1:], strict=False)) and filtering.last_round(process).first().round == len(rounds)
    assert run(recycle=1.0, errors=False)[1].count() == 1  # no call is surer than certain
    one = filtering.semi_supervised(transcripts.where("label <> 'Discard'"), ["tpm"], busco, trees=5)[0]
    assert one.count() == 130
    with pytest.raises(ValueError):
        filtering.semi_supervised(transcripts, ["tpm"], busco, max_iter=0)


def test_ablation_and_out_of_fold(spark, transcripts):
    busco = spark.createDataFrame([], "transcript_id int, status string")
    a = {r.left_out: r for r in filtering.ablation(transcripts, ["tpm", "noise"], busco, trees=5, per_split=1, max_iter=1).collect()}
    assert set(a) == {None, "tpm", "noise"} and a[None].kept_change == 0 and a["tpm"].error > a[None].error
    t = transcripts.withColumn("y", (F.col("transcript_id") % 2 == 0).cast("double"))
    for kind in ("logistic", "forest"):
        s = filtering.out_of_fold(t, ["tpm", "noise"], kind, trees=10)
        assert s.count() == 160 and ev.curve_summary(s, label="y").first().roc_auc > 0.95
    assert filtering.out_of_fold(t.where("y = 1"), ["tpm"]).count() == 0


def test_codons(spark):
    t = spark.createDataFrame([("TTTTAGATGAAAATGCCC", 13)], "s string, p int")
    assert t.select(sq.previous_start("s", F.col("p"))).first()[0] == 7
    assert t.select(sq.previous_start("s", F.lit(4))).first()[0] is None
    first, last = sq.end_codons(F.lit("ATGAAATAA"))
    assert tuple(t.select(first, last, sq.fill_plan(first, last)).first()) == ("ATG", "TAA", "none")


def test_sources(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert {(r.seq_id, r.seq) for r in tables.read_fasta(spark, put("a.fa", ">s1 A>G x\nACG\nTT\n>sp|Q9|n\nGG\n")).collect()} == {("s1", "ACGTT"), ("sp|Q9|n", "GG")}
    assert {r.seq_id for r in tables.read_fasta(spark, str(tmp_path / "a.fa"), "|", 1).collect()} == {"s1", "Q9"}
    assert {(r.seqid, r.length) for r in tables.read_lengths(spark, put("x.fai", "c1\t50\t3\n")).unionByName(tables.read_lengths(spark, put("h.sam", "@HD\tVN:1\n@SQ\tSN:c2\tLN:70\n"))).collect()} == {("c1", 50), ("c2", 70)}
    assert tables.read_cpc2(spark, put("c.tsv", "#ID\tlabel\na\tcoding\nb\t NonCoding\n")).collect() == [("b",)]
    assert [tuple(r) for r in tables.read_junctions(spark, put("j", "c1 5 9 2 + x\nc1 7 8 1 ?\nshort 1\n")).orderBy("start").collect()] == [("c1", 5, 9, "+"), ("c1", 7, 8, ".")]
    assert [tuple(r) for r in tables.read_diamond(spark, put("d", "q\t1e-5\t10\t50\nq\t1e-9\t5\t9\nq\t1e-9\t7\t3\n")).collect()] == [("q", 1e-9, 7, 3.0)]
    assert [tuple(r) for r in tables.read_read_starts(spark, put("r.sam", "@HD\nr\t0\tc\t12\tx\nr\t0\tc\tbad\tx\n")).collect()] == [("c", 12)]
    assert [r.pos for r in tables.per_base(tables.read_depth(spark, put("b", "c\t2\t4\t7\n"))).collect()] == [3, 4]
    assert tables.read_summary(spark, put("s.txt", "x C:98.0%[S:90.1%,D:7.9%],F:1.0%,M:1.0%,n:255\n")).first().complete == "98.0"
    assert tables.read_expression(spark, put("e.tsv", "id\tx\tval\nt1\t0\t3.5\n")).collect() == [("t1", 3.5)]
    assert [(r.seqid, r.start, r.strand) for r in tables.read_genewise(spark, put("g", "a.b.5.9.plus\tg\tcds\t1\t2\t.\t+\t0\tid\n//\n")).collect()] == [("a.b", 5, "plus")]
    a = tables.read_augustus(spark, put("u", "c\tA\tgene\t1\t9\t.\t+\t.\tg1\n# % of transcript supported by hints (any source): 50.0\n# CDS introns: 1/2\n###\nc\tA\tgene\t1\t9\t.\t+\t.\tg2\n###\n"))
    assert {tuple(r) for r in a.collect()} == {("g1", 50.0, "1/2"), ("g2", None, None)}
    files = spark.createDataFrame([("x/s1_R1.fq.gz",), ("x/s1_R2.fq.gz",), ("x/s2.fastq",)], "path string")
    assert {(r["sample"], r.one is not None, r.single is not None) for r in tables.fastq_pairs(files).collect()} == {("s1", True, False), ("s2", False, True)}
    with pytest.raises(ValueError):
        tables.fastq_pairs(files.limit(1))
    f = gff3.read_gff3(spark, put("m.gff3", "c\tm\tmRNA\t9\t2\t.\t+\t.\tID=m1;Target=p1 1 2;Rank=2\n"))
    e = gff3.as_evidence(f, "mRNA", "src", "match", ("Target", "Name")).first()
    assert (e.start, e.end, e.source, e.type) == (2, 9, "src", "match") and "Name=p1" in e.attributes
    assert gff3.read_miniprot(spark, str(tmp_path / "m.gff3")).first().identity == 0.0
    tables.fasta_groups(tables.read_fasta(spark, str(tmp_path / "a.fa")), str(tmp_path / "groups"), 1)
    assert spark.read.text(str(tmp_path / "groups")).count() == 4


def test_scores_of_isoforms(spark):
    f = spark.createDataFrame([("s1", "m1", "L", "c", 1, 4), ("s2", "m2", "L", "c", 3, 3)], "source string, mrna string, locus string, chrom string, start long, end long")
    runs = spark.createDataFrame([("c", 2, 4, 100)], "chrom string, start long, end long, depth long")
    got = {r.mrna: (round(r.score, 6), r.length, r.norm_score) for r in scoring.isoform_scores(f, runs).collect()}
    assert got["m1"][:2] == (3 + 3 - 1 - 1, 3) and got["m2"] == (3.0, 0, None)
    assert scoring.select_sources(scoring.isoform_scores(f, runs)).collect() == [("L", "s1")]
