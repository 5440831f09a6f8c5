"""Registered queries against brute force over every row of small tables."""

import collections
import datetime
import random

import pytest

from locusloom.plans import catalogue


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r, day = random.Random(8), datetime.date(1995, 1, 1)
    orders = [(k, day + datetime.timedelta(r.randrange(12))) for k in range(1, 60)]
    items = [(k, n, r.randrange(9), r.randrange(1, 12), float(r.randrange(1, 51)), r.choice((0.05, 0.1)), r.choice("NAR"), r.choice("FO"), day + datetime.timedelta(r.randrange(40))) for k in range(1, 60) for n in (1, 2)]
    items += [(60 + o[0], 1, 3, 4, 20.0, 0.1, "NAR"[o[0] % 3], "F", o[1]) for o in orders[:6]]
    suppliers = [(k,) for k in range(1, 21)]
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long").write.parquet(f"{at}/supplier.parquet")
    track = [("NAR"[k % 3], 24 * (d - day).days, 24 * (d - day).days + 20, k) for k, d in orders]
    features = []
    for k, n, part, supp, q, _, flag, status, d in items:
        s = 24 * (d - day).days + n
        features.append((flag, "+" if status == "F" else "-", s, s + int(q), f"{k}_{n}_{part}_{supp}"))
    return at, track, features, items, suppliers


def test_evidence_queries_read_every_order(spark, tables):
    at, track, features, *_ = tables
    run = lambda name: [tuple(x) for x in catalogue.QUERIES[name](spark, at).collect()]
    met = {f: [(s, e, k) for c, s, e, k in track if c == f[0] and f[2] < e and s < f[3]] for f in features}
    bp = lambda f, m: min(f[3], m[1]) - max(f[2], m[0])
    count = collections.defaultdict(lambda: [0, 0])
    best, mutual, near, free = {}, set(), set(), collections.Counter()
    for f, ms in met.items():
        for m in ms:
            count[f[:2]][0] += 1
            count[f[:2]][1] += bp(f, m)
            if min(bp(f, m) / (f[3] - f[2]), bp(f, m) / 20) >= 0.7:
                mutual.add((f[4], m[2]))
        if ms:
            n, k = max((bp(f, m), -m[2]) for m in ms)
            best[f[4]] = max(best.get(f[4], (0, -99)), (n, k))
        if any(c == f[0] and abs(f[2] - s) <= 5 and abs(f[3] - e) <= 5 for c, s, e, _ in track):
            near.add((f[4],))
    names = {f[4] for f, ms in met.items() if ms}
    for f in features:
        free[f[0]] += f[4] not in names
    whole = {(f[4], f[0], f[2], f[3], len(ms), len({x for s, e, _ in ms for x in range(max(s, f[2]), min(e, f[3]))})) for f, ms in met.items()}
    assert {x[:6] for x in run("coverage_fraction")} == whole
    assert {x[:2]: list(x[2:]) for x in run("overlap_join_count")} == dict(count)
    assert set(run("reciprocal_overlap")) == mutual and mutual
    assert {x[0]: x[1:] for x in run("best_overlap")} == {k: (-b, n) for k, (n, b) in best.items()}
    assert dict(run("conflict_anti")) == {k: n for k, n in free.items() if n}
    assert set(run("junction_support")) == near and near


def test_gaps_read_every_gene(spark, tables):
    at, _, features, *_ = tables
    want = set()
    for chrom in "NAR":
        covered = {x for f in features if f[0] == chrom for x in range(f[2], f[3] + 1)}
        last = min(covered)
        for x in sorted(covered):
            if x - last - 1 >= 10:
                want.add((chrom, last + 1, x - 1))
            last = x
    assert {tuple(x) for x in catalogue.QUERIES["zero_gaps"](spark, at).collect()} == want and want


def test_outer_merge_reads_every_supplier(spark, tables):
    at, _, _, items, suppliers = tables
    a, b = collections.Counter(x[3] for x in items if x[4] > 48), collections.Counter(x[3] for x in items if x[5] > 0.08)
    c = {k for (k,) in suppliers}
    got = {tuple(x) for x in catalogue.QUERIES["outer_feature_merge"](spark, at).collect()}
    assert got == {(k, a[k], b[k], int(k in c)) for k in c | set(a) | set(b)}
