"""Golden vectors and properties of the interval, model, evidence and attribute operators."""

import random

from pyspark.sql import functions as F

from locusloom.functions import sequences as sq
from locusloom.operators import evidence as ev
from locusloom.operators import interval as iv
from locusloom.operators import models
from locusloom.sources import gff3, tables


def test_overlap_join_equals_naive(spark):
    r = random.Random(1)
    a = [(r.choice("xy"), s := r.randrange(500), s + r.randrange(0, 90), i) for i in range(120)]
    b = [(r.choice("xy"), s := r.randrange(500), s + r.randrange(1, 90), i) for i in range(120)]
    da = spark.createDataFrame(a, "chrom string, start long, end long, i int")
    db = spark.createDataFrame(b, "chrom string, b_start long, b_end long, j int")
    got = {tuple(x) for x in iv.overlap_join(da, db, bin_size=16, closed=True).select("i", "j").collect()}
    assert got == {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]}


def test_overlap_fraction(spark):
    t = spark.createDataFrame([(100, 199, 150, 249)], "a long, b long, c long, d long")
    assert t.select(iv.overlap_fraction("a", "b", "c", "d")).first()[0] == 0.5


def test_invalid_training_models(spark):
    rows = {"m1": [(12428249, 12428678), (12427955, 12427959), (12427689, 12427955)], "m2": [(1000, 1200), (1500, 1700)], "m3": [(1000, 1246), (1246, 1250)], "m4": [(1000, 1500), (1400, 1800)], "m5": [(1000, 1200), (1202, 1500)], "m6": [(500, 900)]}
    t = spark.createDataFrame([(m, s, e) for m, x in rows.items() for s, e in x], "mrna string, start long, end long")
    assert {r[0] for r in models.overlapping_cds(t).collect()} == {"m1", "m3", "m4"}


def test_phases(spark):
    t = spark.createDataFrame([("m", "+", 1, 4), ("m", "+", 11, 15), ("m", "+", 21, 26)], "mrna string, strand string, start long, end long")
    assert [r.phase for r in models.phases(t).orderBy("start").collect()] == [0, 2, 0]


def test_winner(spark):
    t = spark.createDataFrame([(1e-50, 1e-40, 1, 1), (1e-9, 1e-9, 100, 120), (None, None, 1, 1)], "a double, b double, la int, lb int")
    assert [r[0] for r in t.select(models.pick_winner("a", "b", "la", "lb")).collect()] == ["A", "B", "tie"]


def test_peptide(spark):
    t = spark.createDataFrame([("MA*KL*",)], "p string")
    assert tuple(t.select(sq.peptide_length("p"), sq.has_internal_stop("p")).first()) == (4, 1)
    assert spark.createDataFrame([("aacgt",)], "s string").select(sq.reverse_complement("s")).first()[0] == "ACGTT"


def test_no_evidence_is_discarded(spark):
    t = spark.createDataFrame([(1, *[None] * 4, 0.1, *[None] * 7)], "transcript_id int, tpm double, coverage double, augustus double, helixer double, repeat double, pfam boolean, lnc double, single_exon boolean, blast_pident double, blast_qcovs double, rex_pident double, rex_qcovs double")
    assert ev.seed_label(ev.flags(t)).first().label == "Discard"


def test_gff3_round_trip(spark, tmp_path):
    text = "##gff-version 3\nc1\ts\tgene\t1\t90\t.\t+\t.\tID=g1\nc1\ts\tmRNA\t1\t90\t.\t+\t.\tID=g1.t1;Parent=g1\nc1\ts\tCDS\t1\t30\t0.5\t+\t0\tID=c1;Parent=g1.t1,g1.t2\textra\nbad line\n"
    (tmp_path / "a.gff3").write_text(text)
    f = gff3.read_gff3(spark, str(tmp_path / "a.gff3"))
    rows = f.orderBy("line_no").collect()
    assert [r.type for r in rows] == ["gene", "mRNA", "CDS"] and rows[2].parents == ["g1.t1", "g1.t2 extra"[:5]]
    assert [r.gene for r in gff3.with_genes(f).collect()] == ["g1"]
    keep, rest = gff3.split_by_ids(f, spark.createDataFrame([("g1.t1",)], "id string"))
    assert (keep.count(), rest.count()) == (2, 1)
    gff3.write_gff3(f, str(tmp_path / "out"))
    assert gff3.read_gff3(spark, str(tmp_path / "out")).count() == 3


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first\nACG\nTT\n>s2\nGG\n")
    assert {(r.seq_id, r.seq) for r in tables.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("s1", "ACGTT"), ("s2", "GG")}


def test_pr_curve(spark):
    t = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1)], "score double, label int")
    r = ev.pr_curve(t).orderBy(F.desc("score")).collect()
    assert [(x.tp, x.seen) for x in r] == [(1, 1), (1, 2), (2, 3)] and abs(r[2].f1 - 0.8) < 1e-9
