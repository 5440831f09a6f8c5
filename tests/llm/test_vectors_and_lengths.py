"""Clustering, whitening and binary packing against plain versions, on awkward rows."""

import hashlib
import json
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusloom.llm import binary_packing, clustering, whitening
from locusloom.llm.scratch import Scratch

VECTORS = "vec_id long, embedding array<float>, cluster string, key string, x double"


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(5)
    mid = r.normal(size=(12, 6)) * 3
    rows = [(i, (mid[i % 12] + r.normal(size=6)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(3, rows[3][1]), (3, rows[9][1]), (None, rows[5][1]), *((700 + i, rows[0][1]) for i in range(300))]
    bad = [(1, None), (2, [1.0] * 5), (4, [1.0] * 5 + [math.nan]), (5, [math.inf] + [0.0] * 5), (6, [None] + [0.0] * 5), (7, []), (8, [0.5] * 7)]
    return rows, bad


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "k", 1.0) for i, v in rows], VECTORS).repartition(5)


def lloyd(x, ids, k, rounds):
    """Plain integer k-means: ties to the smaller number, floors of means, empty clusters stay."""
    order = sorted(range(len(x)), key=lambda i: (ids[i] is None, hashlib.sha256(f"3:{ids[i]}".encode()).hexdigest(), x[i].astype("<i4").tobytes()))
    c = [[int(v) for v in x[i]] for i in order[:k]]

    def nearest(p):
        return min((sum((int(a) - b) ** 2 for a, b in zip(p, y, strict=True)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        at = [nearest(p)[1] for p in x]
        for j in range(len(c)):
            mine = [p for p, a in zip(x, at, strict=True) if a == j]
            if mine:
                c[j] = [sum(map(int, v)) // len(mine) for v in zip(*mine, strict=True)]
    return c, [nearest(p) for p in x]


def as_integers(rows):
    return np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)


@pytest.mark.parametrize("groups", [None, 1, 5])
def test_yinyang_equals_plain_k_means(spark, vectors, groups):
    rows, bad = vectors
    c, want = lloyd(as_integers(rows), [i for i, _ in rows], 10, 6)
    got = clustering.yinyang(frame(spark, rows + bad), Scratch(spark, "t"), dims=6, k=10, rounds=6, groups=groups)
    assert got.centroids.tolist() == c
    assert sorted((r.key is None, r.key, r.cluster, r.distance) for r in got.rows.collect()) == sorted((i is None, i, j, d) for (i, _), (d, j) in zip(rows, want, strict=True))
    assert got.sizes.sum() == len(rows)
    if groups is None:
        assert got.compared < len(rows) * 10 / 2  # the filters settle most


def test_yinyang_bounds_hold_on_ties_and_far_moves():
    r = np.random.default_rng(1)
    for trial in range(40):
        k = int(r.integers(1, 9))
        x, old = r.integers(-3, 4, (80, 2)), r.integers(-4, 5, (k, 2))
        group = clustering.group_centroids(old, int(r.integers(1, 4)))
        a, upper, lower, _ = clustering.first_assignment(x, old, group)
        for _ in range(4):
            new = old + r.integers(-2, 3, old.shape) * (r.random((k, 1)) < 0.6)
            a, upper, lower, _ = clustering.reassignment(x, a, upper, lower, old, new, group)
            d2 = ((x[:, None] - new[None]) ** 2).sum(axis=2)
            assert (a == d2.argmin(axis=1)).all(), trial
            d = np.sqrt(d2)
            assert (upper >= d[np.arange(80), a] - 1e-12).all()
            d[np.arange(80), a] = np.inf
            for g in range(group.max() + 1):
                assert (lower[:, g] <= d[:, group == g].min(axis=1) + 1e-12).all()
            old = new


def test_clusters_of_few_or_no_vectors(spark, vectors):
    rows, bad = vectors
    few = clustering.clustered(frame(spark, rows[:3] + bad), dims=6, k=8)
    assert few.count() == 3 and few.agg(F.sum("distance")).first()[0] == 0
    assert few.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    none = clustering.clustered(frame(spark, bad), dims=6)
    assert none.count() == 0
    assert clustering.clustered(frame(spark, bad).limit(0), dims=6).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        clustering.clustered(frame(spark, [(1, [1e30] * 6)]), dims=6).count()


def test_whitening_against_numpy(spark, vectors):
    rows, bad = vectors
    t = frame(spark, rows + bad)
    m = whitening.fit(t, components=4)
    x = as_integers(rows) + 100_000
    assert m.n == len(rows) and m.sums.tolist() == x.sum(axis=0).tolist()
    y = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(y.T @ y / len(x))[::-1]
    assert np.allclose(m.variances, values, rtol=1e-10)
    got = whitening.whitened(t, m).collect()
    assert len(got) == len(rows)
    w = np.array([r.whitened for r in got])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9
    assert abs(whitening.identity_error(t, m) - np.abs(w.T @ w / len(w) - np.eye(4)).max()) < 1e-12
    assert np.allclose(m.axes @ m.axes.T, np.eye(4), atol=1e-12)
    s = [sum(int(v) for v in col) for col in x.T]
    want = sorted(sum((len(x) * int(a) - b) ** 2 for a, b in zip(p, s, strict=True)) for p in x)
    assert sorted(r.deviation for r in got) == want
    of = {r.key: np.array(r.whitened) for r in got}
    assert np.allclose(of[100], m.axes @ y[100] / np.sqrt(values[:4]), atol=1e-9)


def test_whitening_without_variance_or_rows(spark, vectors):
    rows, bad = vectors
    two = frame(spark, [(1, [0.0, 1.0, 2.0]), (2, [1.0, 1.0, 0.0]), *bad[:1]])
    m = whitening.fit(two)
    assert m.rank == 1 and [sum(v is not None for v in r.whitened) for r in whitening.whitened(two, m).collect()] == [1, 1]
    one = frame(spark, [(1, [0.5, 0.5])])
    m = whitening.fit(one)
    assert m.rank == 0 and whitening.identity_error(one, m) == 0.0 and whitening.whitened(one, m).first().whitened == [None, None]
    none = frame(spark, bad[:1])
    assert whitening.whitened(none, whitening.fit(none)).count() == 0
    assert whitening.deviations(np.array([[3 << 29, 0], [1 << 31, 1 << 31]])) == [9 << 58, None]


ODD = ["", None, "a", " ", "\n", "a b", " a", "a ", "a  b", "a   b", "a\nb", "a \nb", "a\n b", "a\n\nb\n", "tab\there", "\ta", "a\t b", "x\r\ny\r\n\r\nz", "don't we'll 'tis 12ab3 ...", "<|endoftext|>", "a  <|endoftext|> b", "äöü ß 日本語 日本\n語 🙂🙂", " a   b　c", "\x1c a\x1cb \x1cc", "a\x85b \x85c", "z" * 5000, "word " * 3000, "́x é", "a\x00b"]


def test_encoder_equals_the_tokenizer():
    model = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    tok, r = Tokenizer.from_str(model), random.Random(3)
    signs = [" ", " ", " ", "\n", "\t", "\r", "a", "B", "'s", "'", "1", "é", "日", ".", " ", " ", "\x1f", "the", "  "]
    texts = [t or "" for t in ODD] + ["".join(r.choice(signs) for _ in range(r.randrange(1, 30))) for _ in range(4000)]
    # every code point, between letters, digits, after a space, and behind white space
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}z  {chr(c)}" for c in points[k : k + 4096]) for k in range(0, len(points), 4096)]
    texts += ["z" * 200_000, "ab" * 100_000, " " * 5000 + "x", "\n" * 5000, "日本" * 20_000]
    encode = binary_packing.encoder(model)
    for t in texts:
        assert encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t[:50])
    assert binary_packing.ranks_of(json.loads(model)) is not None
    other = json.loads(model)
    other["model"]["merges"] = other["model"]["merges"][::-1]
    assert binary_packing.ranks_of(other) is None
    other = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    assert binary_packing.ranks_of(json.loads(other)) is None
    assert binary_packing.encoder(other)("Ab c") == np.array(Tokenizer.from_str(other).encode("Ab c", add_special_tokens=False).ids, "<u4").tobytes()


def test_binary_packing(spark, tmp_path):
    rows = [*((i, t) for i, t in enumerate(ODD)), (3, "again"), (None, "nobody"), (99, " ".join(f"w{i}" for i in range(3000)))]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, start string, piece int").repartition(3)
    model = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    tok = Tokenizer.from_str(model)
    want = sorted(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for _, t in rows)
    out = binary_packing.decompose(docs, model, longest=64)
    got, parts = out.collect(), {}
    for r in got:
        assert r.length <= 64 and r.length & (r.length - 1) == 0 and len(r.ids) == 4 * r.length
    pieces = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.doc_tokens, r.start))
    texts, now = [], b""
    for r in pieces:
        assert r.start * 4 == len(now)
        now += r.ids
        if len(now) == 4 * r.doc_tokens:
            texts.append(now)
            now = b""
    assert sorted(texts) == want
    # never more pieces than binary digits ask for
    assert len(got) == sum(len(t) // 256 + bin(len(t) // 4 % 64).count("1") for t in want)
    table = Scratch(spark, "t").cut(out, "pieces")
    b = binary_packing.batches(table, tokens=256, seed=3, range_rows=50).collect()
    for r in b:
        parts.setdefault((r.length, r.batch), []).append(r.slot)
    for (n, _), slots in parts.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= 256 // n
    assert sum(len(s) < 256 // n for (n, _), s in parts.items()) <= 7 and len(b) == len(got)
    binary_packing.write_buckets(table, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == len(got)
    assert binary_packing.decompose(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        binary_packing.decompose(docs, model, longest=100)


def test_binary_lengths():
    for n in range(1, 300):
        x = binary_packing.binary_lengths(n, 32)
        assert sum(x) == n and x == sorted(x, reverse=True) and all(v & (v - 1) == 0 for v in x) and x.count(32) == n // 32 and len(set(x) - {32}) == len(x) - x.count(32)
    assert zlib.crc32(b"") == 0
