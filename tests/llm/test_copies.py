"""MinHash components and the filter audit against brute force, on small awkward tables."""

import collections
import itertools
import random
import re

import brute
import duckdb
import numpy as np
import pytest
from conftest import FOLDER, REPEATED, frame, prose
from lastword.llm import audit, frames, minhash


def bigrams(text):
    words = brute.WORD.findall((text or "").encode().translate(brute.LOWER))
    if len(words) < 2:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:]))


def copies(rows):
    """(doc_id, text) -> sorted (doc_id, n_shingles, component_id, kept)"""
    sets = [bigrams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    named = [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]
    return sorted(((i, n, c, i is not None and i == c) for i, n, c in named), key=str)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def chain():
    """Texts of which only neighbours are similar enough, and a crowd around one text that all are near to but
    hardly each other."""
    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    rows = [(100 + k, " ".join(words[8 * k:8 * k + 100])) for k in range(30)]
    base = prose(rng, 90).replace("\n", " ").split(" ")
    for k in range(40):
        mine = list(base)
        for at in rng.sample(range(len(mine)), 4):
            mine[at] = f"y{k}{at}"
        rows.append((200 + k, " ".join(mine)))
    return rows + [(300, " ".join(base))]


@pytest.mark.parametrize("small, pivots", [(8, 3), (2, 1)])
def test_minhash_components(spark, docs, rows, small, pivots, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "PIVOTS", pivots)
    assert tuples(minhash.join(docs)) == copies(rows)
    linked = chain()
    assert tuples(minhash.join(frame(spark, linked))) == copies(linked)


def test_minhash_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 1)
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    monkeypatch.setattr(minhash, "VOLUME", 500)
    monkeypatch.setattr(minhash, "SALTS_OF", 2)
    assert tuples(minhash.join(frame(spark, chain()))) == copies(chain())


def test_minhash_of_repeated_rows_and_null_ids(repeated, rows):
    assert tuples(minhash.join(repeated)) == copies(rows[:12] + REPEATED * 2)


def test_minima_do_not_depend_on_chunks(monkeypatch):
    tokens = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 900).astype(np.uint64))
    size = np.array([0, 300, 0, 1, len(tokens) - 301])
    found = minhash.Sets(tokens, np.concatenate([[0], np.cumsum(size)]), size)
    whole = minhash.signatures(found)
    monkeypatch.setattr(minhash, "CHUNK", 64)
    assert (minhash.signatures(found) == whole).all() and whole.shape == (3, minhash.MINIMA)


def test_empty_tables(spark, empty):
    assert minhash.join(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.mask_counts(audit.masks(empty), labels)).count() == 0


def audited(rows, labels):
    """(doc_id, text, lang) and {doc_id: (quality, toxic)} by going through every order."""
    def fails(text):
        words = re.findall("[^\x20\x09-\x0d]+", text)
        return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text))}

    out = []
    failing = []
    for i, text, _ in rows:
        mine = fails(text or "")
        mine["E"] = any((t or "") == (text or "") and j is not None and (i is None or j < i) for j, t, _ in rows)
        failing.append({f for f, bad in mine.items() if bad})
    for part in {lang or "" for _, _, lang in rows}:
        docs = [(i, failing[k]) for k, (i, _, lang) in enumerate(rows) if (lang or "") == part]
        orders = ["".join(p) for p in itertools.permutations("ABCDE")]
        shares = collections.Counter(next(f for f in o if f in bad) for o in orders for _, bad in docs if bad)
        for o in orders:
            for step, f in enumerate(o, 1):
                here = [(i, bad) for i, bad in docs if not bad & set(o[:step - 1])]
                gone = [i for i, bad in here if f in bad]
                out.append((part, o, step, len(here) - len(gone), len(gone),
                            sum(f in bad for _, bad in docs) - len(gone), sum(bad == {f} for _, bad in docs),
                            sum(labels.get(i, (0, 0))[0] == 1 for i in gone),
                            sum(labels.get(i, (0, 0))[1] == 1 for i in gone), shares[f]))
    return sorted(out)


def audit_rows():
    rng = random.Random(5)
    long = prose(rng, 260)
    texts = [long, long, long.upper(), "same " * 240, "same " * 240, None, "", None, "a # b", "A B C", "x\x0b\x0cy", "É" * 10]
    rows = [(k, t, ["de", None, "", "en"][k % 4]) for k, t in enumerate(texts)]
    return rows + [(None, long, "de"), (None, "only here", "en"), (3, "same " * 240, "en"), (40, "a # b", "fr"), (40, "a # b", "fr")]


@pytest.mark.parametrize("least", [8, 1 << 16])
def test_audit(spark, least, monkeypatch):
    monkeypatch.setattr(audit, "LEAST", max(least, audit.SLICE) if least > 8 else audit.SLICE)
    monkeypatch.setattr(audit, "CELLS", 16 if least > 8 else 1)
    rows = audit_rows()
    labels = {0: (1, 0), 1: (1, 1), 3: (0, 1), 5: (1, None), 40: (None, 1)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for name in ("mask", "part", "hash", "least", "of", "unsure", "n", "held", "id", "q"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    known = spark.createDataFrame([(i, q, t, "x") for i, (q, t) in labels.items()] + [(None, 1, 1, "x"), (1, 0, 0, "x")],
                                  "doc_id long, quality int, toxic int, part string")
    got = sorted(tuple(r) for r in audit.interactions(audit.mask_counts(audit.masks(docs), known)).collect())
    assert got == audited(rows, labels)


def test_sketch_clears_most_unique_texts_and_no_repeat(spark):
    hashed = spark.range(20_000).selectExpr("xxhash64(id % 18000) AS hash")
    bits = audit.sketch(hashed, "hash", 20_000)
    frames.ship(spark)
    marked = hashed.select("hash", audit.possible_repeat(spark, bits, hashed["hash"]).alias("open"))
    found = marked.groupBy("hash").agg({"*": "count", "open": "max"}).toDF("hash", "n", "open").collect()
    assert all(r["open"] for r in found if r["n"] > 1)
    assert sum(r["open"] for r in found if r["n"] == 1) < 1600


def test_audit_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert sorted(tuple(r) for r in audit.op12_filters(spark, FOLDER).collect()) == sorted(db.execute(audit.SQL).fetchall())
