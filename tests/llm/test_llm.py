"""Training-data operators on small fixtures: brute-force versions, round trips, and awkward rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from locusloom.llm import decontamination, exact_dedup, graph, language_id, line_dedup, lm_scoring, near_dedup, packing, toxicity, url_filters, warc
from locusloom.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, key string, grp string, score double, kept boolean"


def words(r, n, stem="w"):
    return [f"{stem}{r.randrange(400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    base = [" ".join(words(r, r.randrange(3, 120))) for _ in range(40)]
    out = [(i, t, "en" if i % 2 else "de", "k", "g", 0.5, True) for i, t in enumerate(base)]
    for i in range(40, 60):
        w = base[i % 12].split()
        w[r.randrange(len(w))] = "zz"
        out.append((i, " ".join(w), "en", None, None, None, None))
    return out + [(60, None, None, None, None, None, None), (61, "", "en", None, None, None, None), (62, base[0], "en", None, None, None, None), (62, base[0], "en", None, None, None, None), (None, base[1], None, None, None, None, None), (63, " ".join(words(r, 9000)), "en", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_exact_dedup(docs, rows):
    norm = lambda t: " ".join((t or "").split())
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    got = exact_dedup.exact_dedup(docs, width=4, growth=2).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter((r.keep_id, r.group_size) for r in got)
    want = collections.Counter()
    for ids in groups.values():
        keep = min((i for i in ids if i is not None), default=None)
        want[(keep, len(ids))] += len(ids)
    assert sizes == want


def test_near_dedup(docs, rows):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").lower().split()
        s = set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())
        if i is not None:
            sets[i] = s
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    for options in ({}, {"hot_bucket": 1, "block": 2}, {"largest_family": 1}):
        got = near_dedup.near_dedup(docs, **options).collect()
        assert len(got) == len(rows)
        assert all(r.component_id == root(r.doc_id) and r.n_shingles == len(sets[r.doc_id]) for r in got if r.doc_id is not None)


def test_components_of_a_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    got = dict(graph.components(e, Scratch(spark, "t"), "c").collect())
    assert set(got.values()) == {0, 100} and len(got) == 53


def test_packing_is_whole_and_gapless(docs, rows):
    got = packing.pack_documents(docs, seq_len=64, block_size=30, generations=4).collect()
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = collections.Counter()
    for i, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            want[(i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(np.array(ids[k : k + 64], "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seq = collections.defaultdict(list)
    for r in got:
        seq[r.sequence_id].append((r.offset, r.length))
    for x in seq.values():
        x.sort()
        assert x[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(x, x[1:], strict=False)) and sum(b for _, b in x) <= 64


def test_token_ids_around_letters_that_lower_case_splits(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t, encode = Tokenizer.from_file(path("word_bpe_49k.json")), packing._encoder(open(path("word_bpe_49k.json"), encoding="utf-8").read())
    for text in ("KAPI\u0130.", "a\u0130, b", "\u0130\u0130.\u0130", "\u03a3. x", "it's A.B, C", "\u0130"):
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_fm_index():
    r = np.random.default_rng(1)
    seq = r.integers(1, 6, 400)
    index = decontamination.FMIndex(seq)
    pats = [seq[i : i + n] for i, n in ((3, 4), (100, 2), (390, 3))] + [np.array([9, 9])]
    p, n = np.zeros((4, 5), np.int64), np.array([len(x) for x in pats])
    for k, x in enumerate(pats):
        p[k, 5 - len(x) :] = x
    lo, hi = index.search(p, n)
    for k, x in enumerate(pats):
        want = [i for i in range(len(seq) - len(x) + 1) if (seq[i : i + len(x)] == x).all()]
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == want


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(20))
    d = spark.createDataFrame([(1, "x " * 50 + item.upper() + " y" * 50, "e"), (2, "clean text", "e"), (3, None, "e"), (4, "Two-WORDS", "e"), (5, "a " * 500 + "two words", "e")], "doc_id long, text string, items string")
    b = spark.createDataFrame([(7, item), (8, "two words"), (9, None), (10, "...")], "item_id long, text string")
    for options in ({}, {"block_bytes": 20}):
        got = {r.doc_id: r for r in decontamination.contamination(d, b, **options).collect()}
        assert [(got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) for i in range(1, 6)] == [(120, 20, 1, True), (2, 0, 0, False), (0, 0, 0, False), (2, 2, 1, True), (502, 2, 1, False)]
    assert decontamination.contamination(d, b.limit(0)).where("contaminated").count() == 0


def test_lm(docs, rows):
    got = lm_scoring.lm_score(docs, chunk_bytes=2000).collect()
    again = {(r.doc_id, round(r.score, 6)) for r in lm_scoring.lm_score(docs).collect()}
    assert {(r.doc_id, round(r.score, 6)) for r in got} == again
    c, tok = collections.Counter(), lambda t: [*(t or "").lower().split(), "$"]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    for i, t, *_ in rows:
        if not held(i):
            c.update(tok(t))
    n, v = sum(c.values()), len(c)
    for i, t, *_ in rows:
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t))
        assert any(r.doc_id == i and abs(r.base_score - want) < 1e-6 and r.n_tokens == len(tok(t)) and r.n_known == sum(c[w] > 0 for w in tok(t)) and r.held_out == held(i) for r in got)


def test_language_and_toxicity(spark):
    r = random.Random(2)
    d = [(i, " ".join(words(r, 60, "straße" if i % 2 else "the")) + (" badword" + r.choice("abc") if i % 3 == 0 else ""), "de" if i % 2 else "en") for i in range(160)] + [(900, None, None), (901, "123 !", "en"), (None, "the the", None)]
    df = spark.createDataFrame(d, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in language_id.predict(df, language_id.train(df)).collect()}
    assert len(got) == len(d) and got[900].lang_pred == got[901].lang_pred == "und"
    assert sum(got[i].lang_pred == lang for i, _, lang in d[:160]) > 150
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)] + [(5, None)], "doc_id long, toxic int")
    tox = {x.doc_id: x for x in toxicity.predict(df, toxicity.train(df, labels)).collect()}
    held = [i for i in range(160) if tox[i].held_out]
    assert sum(tox[i].predicted == (i % 3 == 0) for i in held) > 0.8 * len(held)
    assert language_id.predict(df, language_id.train(df.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert toxicity.predict(df, toxicity.train(df, labels.limit(0))).where("predicted = 1").count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * (i % 4) if i else None) for i in range(30)] + [(7, "http://h/7", "xxx")], "page_id long, url string, html string")
    for least in (0, 2):
        at = f"file://{tmp_path}/w{least}"
        m = warc.write_warc(pages, at, least_bytes=least, roll_bytes=600, shards=3)
        got = warc.read_warc(spark, at).collect()
        assert len(got) == 31 and m.count() > 3 and m.agg(F.sum("records")).first()[0] == 31
        for r in got:
            size = r.page_id % 4
            top = max(i for i in range(30) if i % 4 == size)
            assert r.refers_to == (top if size >= least and r.page_id != top else None) and r.payload_bytes == size
    empty = f"file://{tmp_path}/none"
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_url_filters(spark):
    log = spark.createDataFrame([("x.com", 10, "block"), ("x.com", 20, "remove"), ("a.x.com", 12, "allow"), ("x.com/bad", 5, "block"), (None, 1, "block"), ("x.com", 10, "block")], "entry string, day int, action string")
    cap = spark.createDataFrame([(1, "http://b.x.com/", 10), (2, "http://a.X.com./", 12), (3, "http://x.com:80/bad/q?z", 30), (4, "http://x.com/", 20), (5, None, 1), (6, "no host", 3), (7, "http://x.com/", None)], "page_id long, url string, day int")
    got = {r.page_id: r for r in url_filters.judge(cap, log).collect()}
    assert [got[i].decision for i in range(1, 8)] == ["block", "allow", "block", "allow", "allow", "allow", "allow"]
    assert url_filters.judge(cap, log.limit(0)).where("decision <> 'allow'").count() == 0
    more = spark.createDataFrame([("localhost", 1, "block"), ("1.2.3.4", 1, "block"), ("3.4", 1, "allow"), ("localhost/a", 1, "allow")], "entry string, day int, action string")
    cap = spark.createDataFrame([(1, "http://localhost/b", 5), (2, "http://localhost/a/c", 5), (3, "http://1.2.3.4/", 5), (3, "http://1.2.3.4/", 5)], "page_id long, url string, day int")
    got = sorted((r.page_id, r.n_active, r.decision) for r in url_filters.judge(cap, more).collect())
    assert got == [(1, 1, "block"), (2, 2, "allow"), (3, 1, "block"), (3, 1, "block")]


def test_line_blocks_against_brute_force(spark):
    """Codes of all blocks, by counting every word's votes one by one; lines beyond one chunk of counters as well."""
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(9999)}" for _ in range(n)) for n in (5, 9, 40, 127, 128, 400, 1500)]
    rows = line_dedup.lines_of(spark.createDataFrame([(1, "\n".join(texts))], "doc_id long, text string"), 5)
    got = {r.line_no: r for r in line_dedup.blocks(rows).collect()}
    for k, text in enumerate(texts):
        dealt = collections.defaultdict(list)
        for w in set(text.split()):
            h = xxhash.xxh64_intdigest(w.encode(), seed=42)
            dealt[(h - (1 << 64) if h >> 63 else h) % line_dedup.BLOCKS].append(h)
        for j in range(line_dedup.BLOCKS):
            code, n = 0, len(dealt[j])
            for c, shift in (("x", 6), ("y", 7)):
                for i in range(8):
                    votes = n if (c, i) == ("y", 0) else sum(h >> (8 * i + shift) & 1 for h in dealt[j])
                    code |= (votes * 2 > n) << (16 * (i // 2) + i % 2 + 2 * (c == "y"))
            assert (got[k][f"n{j}"], got[k][f"b{j}"] & ((1 << 64) - 1)) == (n, code)


def test_line_groups(spark):
    """Families of near-equal lines, any two of which differ in two words: one line of each stays."""
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    lines, first = [], set()
    for copies, n in ((1, 300), (2, 300), (3, 40), (4, 300), (9, 60)):
        base = [rnd.choice(vocabulary) for _ in range(n)]
        first.add(len(lines))
        for _ in range(copies):
            w = list(base)
            w[rnd.randrange(n)] = rnd.choice(vocabulary)
            lines.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.line_dedup(docs).where("removed_lines = 0").collect()} == first


def test_lines_alike_by_blocks_but_not_by_letters_stay(spark):
    """Lines that share two blocks but not four fifths of their letters are met and left alone; one letter links."""
    rnd = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnpq"]
    base = [rnd.sample(vocabulary, 24) for _ in range(20)]
    block = lambda w: (lambda h: (h - (1 << 64) if h >> 63 else h) % line_dedup.BLOCKS)(xxhash.xxh64_intdigest(w.encode(), seed=42))
    lines = [" ".join(w) for w in base]
    for w in base:
        lines.append(" ".join(x if block(x) < 2 else next(y for n in range(99) if block(y := x[::-1] * 3 + "z" * n) > 1) for x in w))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    keys = [set(r.k) for r in line_dedup.blocks(line_dedup.lines_of(docs, 5)).select("doc_id", line_dedup.keys().alias("k")).orderBy("doc_id").collect()]
    assert sum(bool(keys[k] & keys[20 + k]) for k in range(20)) > 5
    assert line_dedup.line_dedup(docs).where("removed_lines > 0").count() == 0
    docs = docs.unionByName(spark.createDataFrame([(100 + k, x + "s") for k, x in enumerate(lines)], docs.schema))
    assert {r.doc_id for r in line_dedup.line_dedup(docs).where("removed_lines = 1").collect()} == {100 + k for k in range(40)}


def test_line_dedup_rows_that_repeat_an_id(spark):
    """Rows are told apart by id and text; columns of any name pass through."""
    line, other = "the same five words here", "a wholly different line of text"
    rows = [(1, line, 1), (2, line, 2), (2, other, 3), (2, other, 4), (None, line, 5), (None, "words that stand in no other row", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone int").withColumn("removed_lines", F.lit("x")).withColumn("th", F.lit(0)).withColumn("id", F.lit(0))
    got = {r.gone: r for r in line_dedup.line_dedup(docs).collect()}
    assert [got[k].text for k in range(1, 7)] == [line, "", other, other, "", rows[5][1]]
    assert got[2]._removed_lines == 1 and got[2].removed_lines == "x"


def test_line_dedup(spark):
    r = random.Random(3)
    long = words(r, 150)
    other = [*long[:70], "changed", *long[71:]]
    d = [(1, "one two three four five\n" + " ".join(long) + "\n\nshort", "k"), (2, "ONE two, three four five!\nown line of this text here", "k"), (3, " ".join(other) + "\nshort", "k"), (4, None, "k"), (5, "", "k"), (None, "one two three four five", "k")]
    got = {x.doc_id: x for x in line_dedup.line_dedup(spark.createDataFrame(d, "doc_id long, text string, key string")).collect()}
    assert got[1].text == d[0][1] and got[2].text == "own line of this text here" and got[3].text == "short"
    assert got[4].text is None and got[5].text == "" and got[None].text == "" and got[3].key == "k"


def test_empty_tables(docs):
    none = docs.limit(0)
    for f in (exact_dedup.exact_dedup, near_dedup.near_dedup, lm_scoring.lm_score, line_dedup.line_dedup, packing.pack_documents):
        assert f(none).count() == 0


def test_line_recall_against_brute_force_edit_similarity(spark):
    """Lines of 5-60 words with one word replaced, one letter added, or both; pairs by edit similarity alone."""
    rnd = random.Random(23)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(3, 9))) for _ in range(3000)]
    base = [[rnd.choice(vocabulary) for _ in range(5 + k % 56)] for k in range(224)]
    lines = [" ".join(w) for w in base]
    for k, w in enumerate(base):
        w = list(w)
        if k % 3 != 1:
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        if k % 3 != 0:
            at = rnd.randrange(len(w))
            w[at] += "q"
        lines.append(" ".join(w))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    alike = {k for k in range(224) if distance(lines[k], lines[224 + k]) <= 0.2 * max(len(lines[k]), len(lines[224 + k]))}
    removed = {r.doc_id for r in line_dedup.line_dedup(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).where("removed_lines = 1").collect()}
    found = {k for k in alike if 224 + k in removed}
    assert len(alike) > 200 and removed == {224 + k for k in found} and len(found) >= 0.97 * len(alike), (len(found), len(alike))


def test_toxic_term_late_in_a_long_word(spark):
    """One run of letters, Latin or not: n-grams beyond byte 200 count in prediction and in training."""
    term, z = "zzbadzz", np.zeros(toxicity.BUCKETS)
    inner = [zlib.crc32(term.encode()[i : i + n]) % toxicity.BUCKETS for n in toxicity.GRAMS for i in range(len(term) - n + 1)]
    z[inner] = 50.0
    texts = ["a" * 400, "字" * 130] + [f"{'a' * n}{term}{'a' * (393 - n)}" for n in (230, 251, 300, 393)] + ["字" * 90 + term + "字" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.predict(docs, (z, 0.0)).collect()}
    assert all(got[i] > max(got[0], got[1]) + 0.1 for i in range(2, 7)), got
    labels = spark.createDataFrame([(i, int(i > 1)) for i in range(7)], "doc_id long, toxic int")
    learned = toxicity.training_docs(docs, labels, 50, 16, 1000)
    toxic = [windows for y, windows in learned if y]
    assert toxic and all(set(inner) <= {g for w in windows for x in w for g in toxicity.grams_of(x)} for windows in toxic)


def test_lm_against_brute_force_backoff(spark):
    """Scores of a skewed corpus (a passage repeated often) and the mass of each state."""
    r = random.Random(31)
    texts = ["boiler plate text always follows"] * 60 + [" ".join(words(r, 30)) for _ in range(20)] + [f"boiler {w} text w3 always w{i}" for i, w in enumerate(["new", "w1", "w2", "plate"] * 10)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    one, two, after = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for i, t in enumerate(texts):
        if not held(i):
            w = ["^", *t.split(), "$"]
            one.update(w)
            two.update(zip(w, w[1:], strict=False))
            for a, b in zip(w, w[1:], strict=False):
                after[a].add(b)
    n, v = sum(one.values()) - one["^"], len(one) - 1

    def p(a, b):
        if two[a, b]:
            return (two[a, b] - 0.6) / one[a]
        return (0.6 * len(after[a]) / one[a] if one[a] else 1.0) * (one[b] + 1) / (n + v + 1)

    assert all(sum(p(a, b) for b in one if b != "^") <= 1 + 1e-9 for a in one if a != "$")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (300, 1 << 20):
        got = {x.doc_id: x.score for x in lm_scoring.lm_score(docs, chunk_bytes=size).collect()}
        for i, t in enumerate(texts):
            w = ["^", *t.split(), "$"]
            assert got[i] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(w, w[1:], strict=False)), abs=1e-6)


def forward(model, text):
    """The network's mean logits of one text, one window and one filter at a time."""
    data = text.encode("utf-8", "replace").translate(language_id._LOWER)
    total, n = np.zeros(len(model.classes)), len(data)
    for at in range(0, n, language_id.WINDOW):
        x = np.frombuffer(data[at : at + language_id.WINDOW].ljust(language_id.WINDOW, b"\0"), np.uint8)
        total += model.logits(x[None, :])[0] * min(language_id.WINDOW, n - at)
    return total / n


def test_language_of_whole_texts_by_naive_windows(spark):
    r = random.Random(4)
    d = [(i, " ".join(words(r, 40, "straße" if i % 2 else "the")), "de" if i % 2 else "en") for i in range(120)]
    model = language_id.train(spark.createDataFrame(d, "doc_id long, text string, lang string"))
    texts = ["the the the", " ".join(words(r, 900, "straße")), "x" * 5000, "123", "", None]
    rows = spark.createDataFrame([(1, t, n) for n, t in enumerate(texts)] + [(1, texts[0], 9)], "doc_id long, text string, row int").withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit(0))
    got = {x.row.row: x for x in language_id.predict_rows(rows, model).select("row", F.col("lang_pred").alias("p"), F.col("score").alias("s")).collect()}
    for n, text in enumerate(texts[:3]):
        z = forward(model, text)
        p = np.exp(z - z.max())
        p /= p.sum()
        assert got[n].p == model.classes[int(p.argmax())] and got[n].s == pytest.approx(p.max(), abs=1e-5)
    assert [got[n].p for n in (3, 4, 5)] == ["und"] * 3 and got[9].p == got[0].p


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Each stage decides row by row: null and repeated ids, empty texts, clashing names; and an empty table."""
    import corpus_pipeline

    r = random.Random(9)
    text = lambda n: " ".join(words(r, n))
    a, b, item = text(60), text(60), " ".join(f"q{i}" for i in range(30))
    near = a.split()
    near[30] = "zz"
    rows = [(1, a), (2, a), (3, " ".join(near)), (None, b), (None, b), (None, item), (4, item + " tail"), (5, "12 34"), (6, ""), (7, None), (8, text(50)), (8, "own words of a row that repeats an id"), (9, text(3000))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, gone int").withColumn("row", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at, kept = str(tmp_path), {}
    left = spark.read.parquet(f"{at}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, left, at).write.parquet(str(tmp_path / f"s{k}"))
        left = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k < 4:
            assert left.columns == docs.columns
            kept[name] = {x.gone for x in left.collect()}
    assert kept["language ID"] == set(range(13)) - {7, 8, 9}
    lines = kept["line dedup"]  # equal and near lines go, and documents of nothing else with them; rows equal in id and text share
    assert 0 in lines and not {1, 2} & lines and {3, 4} <= lines and {5, 6} & lines and {10, 11, 12} <= lines
    assert len(kept["near-dedup"] & {3, 4}) == 1 and kept["decontamination"] == kept["near-dedup"] - {5, 6}
    assert left.select("doc_id").distinct().count() == len({rows[k][0] for k in kept["decontamination"]}) and left.where("offset IS NULL").count() == 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, at)
    assert empty.count() == 0
