"""Sharding, packing, quality, decontamination, urls, search and extraction on small awkward tables."""

import collections
import random
import zlib

import brute
import numpy as np
import pytest
from conftest import FOLDER, REPEATED, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from lastword.llm import catalogue, decontaminate, extract, packing, pages, quality, sharding, topk, urls
from pyspark.sql import functions as F


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_shards(repeated, rows):
    found = sharding.assign(repeated).collect()
    given_rows = rows[:12] + REPEATED * 2
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 1, crc(t)) for i, t in given_rows)
    slots = collections.defaultdict(list)
    for r in found:
        key = r.doc_id if r.doc_id is not None else r.text_crc32
        assert (r.shard, r.grown_shard, r.law) == (brute.jump(key, 16), brute.jump(key, 17), "key")
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_move_only_into_the_new_one(spark):
    ids = spark.createDataFrame([(i * 7919 - 10**6, None) for i in range(3000)], "doc_id long, text string")
    found = sharding.assign(ids, 5).collect()
    assert all(r.grown_shard in (r.shard, 5) for r in found)
    assert 0.1 < sum(r.grown_shard == 5 for r in found) / len(found) < 0.24
    assert all(r.shard == brute.jump(r.doc_id, 5) for r in found)


def encoded(text):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path(packing.VOCABULARY)).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_round_trip(repeated, rows, docs):
    for table, given_rows in ((docs, rows), (repeated, rows[:12] + REPEATED * 2)):
        found = packing.pack(table, 64).collect()
        ids = {r: encoded(r[1]) for r in set(given_rows)}
        want = collections.Counter()
        for row in given_rows:
            for k, low in enumerate(range(0, len(ids[row]), 64)):
                part = np.array(ids[row][low:low + 64], "<u4")
                want[row[0], k, low, len(part), zlib.crc32(part.tobytes())] += 1
        assert collections.Counter(tuple(r)[:5] for r in found) == want
        bins = collections.defaultdict(list)
        for r in found:
            bins[r.sequence_id].append((r.offset, r.length))
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 64
        assert len(bins) <= -(-sum(r.length for r in found) // 64) * 1.05 + 1


def test_packing_keeps_ids(docs):
    for r in packing.pieces(docs, keep_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'sStTrevldm \n12é.,!’ß\xa0ıœż́<|>中", max_size=25), min_size=1, max_size=6))
def test_encoder_equals_the_library(texts):
    encoder = packing._ENCODERS.setdefault(packing.VOCABULARY, packing._ENCODERS.get(packing.VOCABULARY)
                                           or packing.Encoder(packing.VOCABULARY))
    whole = [e.ids for e in encoder.whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder(texts)] == whole


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    encoder, rng = packing.Encoder(packing.VOCABULARY), random.Random(2)
    for _ in range(20):
        text = " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60))
        assert encoder([text])[0].tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), min_size=1, max_size=12))
def test_plan_takes_every_piece_once(histogram):
    taken = collections.Counter()
    for combination, times in packing.plan(histogram, 30):
        assert sum(combination) <= 30
        for length in combination:
            taken[length] += times
    assert taken == collections.Counter(histogram)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.lists(st.integers(1, 20), max_size=9))
def test_fullest_is_the_largest_sum(target, lengths):
    counts = np.bincount(lengths, minlength=41)
    found = packing.fullest(target, counts, [x for x in sorted(set(lengths), reverse=True) if x <= target])
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= target}
    assert sum(found) == max(sums) and not collections.Counter(found) - collections.Counter(lengths)


def test_quality_held_out_accuracy(spark):
    table = catalogue.QUERIES["op10_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = table.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in table.collect())


def test_quality_awkward(spark, docs, repeated, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 54)] + [(7, 0, 0), (8, None, None)],
                                   "doc_id long, quality int, toxic int")
    found = quality.score(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert quality.score(empty, labels).count() == 0
    assert {r.score for r in quality.score(repeated, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(repeated, labels.where("quality = 1"))
    assert kept.columns == repeated.columns and kept.count() == repeated.count()


def test_quality_learns_from_its_fold_only(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert tuples(quality.score(docs, labels)) == tuples(quality.score(docs, other))


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
         (2, "Short item, here!"), (3, None), (4, ""), (None, "zeta eta theta iota"), (10, "short ITEM here"),
         (5, "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (1, "?!")]
TEXTS = [(1, "a b one two three four five six seven eight nine ten eleven twelve thirteen c d"), (2, None), (3, ""),
         (4, "a Short item: HERE, and zeta-eta theta iota"), (5, "one two three"), (6, "short item here " * 40),
         (7, "x " * 300 + "short item here"), (8, " ".join(ITEMS[0][1].split() + ["fifteen"])), (9, "short item"),
         (9, "short item"), (None, "zeta eta theta iota")]


def test_contamination(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(1))
    docs = frame(spark, TEXTS)
    found = decontaminate.contamination(docs, items)
    want = brute.hits(TEXTS, [(str(i) if i is not None else None, t) for i, t in ITEMS])
    assert tuples(found.drop("key", "items", "spans")) == want
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(w[0]) for w in want if not w[5])


def test_contamination_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(empty, items).count() == 0
    clean = decontaminate.contamination(docs, items.limit(0))
    assert clean.count() == docs.count() and clean.where("contaminated OR n_hit > 0").count() == 0


URLS = [("http://a.net/x", "a.net", "/x", "net/", "block"), ("http://a.net", "a.net", "", None, "allow"),
        ("https://www.Example.NET/en/1?q#f", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
        ("x://m.example.com/de/?a", "m.example.com", "/de/", "example.com/de/", "block"),
        ("http://org/fr/a#b?c", "org", "/fr/a", "org/fr/", "allow"), ("http://b.org/FR/", "b.org", "/FR/", None, "allow"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("http://?a/b", "", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
        ("http://a.net/x", "a.net", "/x", "net/", "block")]


def test_url_rules(spark):
    rows = [(i, u[0]) for i, u in enumerate(URLS)]
    table = spark.createDataFrame(rows, "page_id long, url string").withColumns({"tokens": F.lit(1), "rule": F.lit("x")})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = urls.judge(table, labels).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [u[1:] for u in URLS]
    assert urls.judge(table.limit(0), labels).count() == 0


def test_mined_rules(spark):
    rng, rows, labels = random.Random(3), [], []
    for i in range(900):
        spam = i % 3 == 0
        host = "pills.example.com" if spam else rng.choice(["a", "b", "c"]) + ".example.com"
        rows.append((i, f"http://{host}/{rng.choice(['en', 'fr'])}/{i}"))
        labels.append((i, int(not spam or rng.random() < 0.05), 0))
    rows += [(1000, "https://pills.example.com/it/none"), (1001, "https://d.example.com/en/none"), (None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = urls.judge(table, marks).collect()
    # Brute force: a page is blocked if all tokens of any kept rule are among its own.
    kept = [set(r.tokens) for r in urls.mine(urls.labelled(table, marks)).collect()]
    assert kept and all("h:pills" in rule for rule in kept)
    tokens = {r.url: set(r.t) for r in table.select("url", urls.tokens(F.col("url")).alias("t")).collect()}
    by_id = dict(rows)
    for r in found:
        assert (r.verdict == "block") == any(rule <= tokens[by_id[r.page_id]] for rule in kept)
    verdicts = {r.page_id: r.verdict for r in found}
    assert verdicts[1000] == "block" and verdicts[1001] == "allow" and verdicts[None] == "allow"


def top(rows, k=10):
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def test_search(spark):
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(6)]) for i in range(700)]
    rows += [(700, None), (800, []), (900, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1000, [float("nan")] * 6),
             (1100, [float("inf")] + [0.0] * 5), (1200, [1.0, 2.0]), (1201, [0.5, 0.5]), (None, [1.0] * 6),
             (1300, [0.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    every = topk.usable(table)
    found = topk.search(every.where("vec_id % 100 = 0"), every)
    assert tuples(found) == top(rows)
    none = topk.usable(table.limit(0))
    assert topk.search(none, none).count() == 0


def top_of_rows(rows, k=10):
    """As top, but a query leaves out its own row only, not the others of its id."""
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows]
    out = []
    for at, (i, q) in enumerate(ok):
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, (j, v) in enumerate(ok)
                            if n != at and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def test_search_of_repeated_ids(spark):
    rng = random.Random(6)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(6)]) for i in range(1, 60)]
    rows += [(100, [1.0, 0.5, 0.0, -1.0, 0.0, 2.0])] * 2 + [(200, [0.5] * 6)] * 12  # equal rows
    rows += [(300, [float(j == n) for n in range(6)]) for j in range(4)]  # different rows of one id
    rows += [(7, [2.0] * 6)] * 3
    every = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert tuples(topk.search(every.where("vec_id % 100 = 0"), every)) == top_of_rows(rows)


def test_search_of_large_components(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 10.0 ** rng.choice((0, 3, 5, 9, 20, 37))) for _ in range(6)]) for i in range(1, 900)]
    rows += [(1000, [16384.0] + [0.0] * 5), (1001, [-16384.0] + [0.0] * 5), (1002, [16383.5] * 6), (1100, [0.0] * 6),
             (1200, [3e38] * 6), (1300, [-3e38] * 6), (1301, [float("inf")] * 6), (1302, [3e38] * 6)]
    for kind, cast in (("float", np.float32), ("double", float)):
        extra = [(1400, [1e308] * 6), (1401, [-1.7e308] * 6), (1402, [1e200] * 6)] if kind == "double" else []
        table = spark.createDataFrame(rows + extra, f"vec_id long, embedding array<{kind}>").repartition(3)
        every = topk.usable(table)
        found = tuples(topk.search(every.where("vec_id % 100 = 0"), every))
        want = []
        ok = [(i, [int(x * 1024 // 1) if abs(x) < 2**53 else int(x) * 1024 for x in v]) for i, v in
              ((i, [float(cast(x)) for x in v]) for i, v in rows + extra) if np.isfinite(v).all()]
        for i, q in ok:
            if i % 100 == 0:
                scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)
                want += [(i, n + 1, j, -s if abs(s) < 2**63 else None) for n, (s, j) in enumerate(scores[:10])]
        assert found == sorted(want, key=str)


def test_search_equals_brute_force_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert tuples(catalogue.QUERIES["op4_topk"](spark, FOLDER)) == top(rows)


def test_leaves():
    page = ("<html><head><title>no</title><script>var t='</p>';</script></head><body><!-- no <p>x</p> -->"
            "<p>A &amp; <b>b&nbsp;<i>c</i><br>d<p>e <a href='/'>f</a></p><div class=\"x y-z\" id=q>g<h2>h</h2> i </div>"
            "<ul><li>j<li>k</ul> 1 < 2 <p title='>'>l</p><style>m")
    found = pages.leaves(page)
    assert [x.text for x in found] == ["A & b c d", "e f", "g", "h", "i", "j", "k", "1 < 2", "l"]
    assert found[2].path == ("html", "body", "div", ".x", ".y", ".z", ".q") and found[5].path[-1] == "li"
    assert pages.leaves("") == [] and pages.leaves("<") [0].text == "<" and pages.leaves("<p a='") == []


def gold(page):
    import html
    import re
    inner = re.search("<article>(.*)</article>", page, re.S)[1].replace("<br>", " ").replace("<b>", "")
    blocks = (" ".join(html.unescape(b).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_extraction_of_the_table(spark):
    found = {r.page_id: r for r in catalogue.QUERIES["op3_extract"](spark, "/root/testdata/sf0.01").collect()}
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(found) == len(table) and all(r.n_chars == len(r.text) for r in found.values())
    assert sum(found[r.page_id].text == gold(r.html) for r in table) >= 0.97 * len(table)


def test_extraction_awkward(spark):
    long = "<article>" + "<p>many words of one page</p>" * 3000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (4, "u", "<nav>x</nav>"), (5, "u", long), (5, "u", long)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    found = extract.extract(table).collect()
    assert len(found) == 6 and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id in (1, 2, None)] == [""] * 3
    assert len({r.text for r in found if r.page_id == 5}) == 1
    assert extract.extract(table.limit(0)).count() == 0


def test_gradients_are_those_of_the_loss():
    from lastword.llm import blstm
    rng = np.random.default_rng(0)
    model = blstm.Labeller(2)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    mask = np.ones((4, 2))
    mask[3, 1] = 0
    at = np.array([(i, rng.integers(0, 50)) for i in range(7)])
    batch = blstm.Batch(rng.normal(size=(4, 2, 2)), at, at, mask)
    labels = rng.integers(0, 2, (4, 2)).astype(float)

    def loss():
        p = blstm.sigmoid(model.forward(batch)[0])
        return -(mask * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / mask.sum()

    found = model.gradients(batch, labels)
    for name, spot in (("f_own", (2, 5)), ("b_in", (3, 20)), ("f_bias", (40,)), ("out", (7, 0)), ("path", (at[0, 1], 3))):
        weight = model.weights[name]
        old = weight[spot]
        weight[spot] = old + 1e-3
        high = loss()
        weight[spot] = old - 1e-3
        low = loss()
        weight[spot] = old
        assert found[name][spot] == pytest.approx((high - low) / 2e-3, rel=0.05, abs=2e-5)
