"""Near words, forms and roots against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from lastword.llm import textops, variants

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOW)
            mark = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if mark % 31 == 0:
                at = mark % len(word)
                word = word[:at] + word[at + 1:]
            found[word] += len(word) >= 7
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def told(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None)
                   for w, n in words.items()), key=str)


def misspelt(rng, n=220):
    """Texts with a few stems at very different frequencies, and edits of them and of their edits."""
    stems = ["encyclopaedia", "lettersé", "wonderful", "aaaaaaaa", "aaaaaaaab", "zwölftausend", "straßenbahn", "ÀÉÎÕÜñç", "x" * 90]
    texts = []
    for k in range(n):
        words = []
        for _ in range(rng.randrange(1, 40)):
            word = stems[min(int(rng.expovariate(0.6)), len(stems) - 1)]
            for _ in range(rng.choice([0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", rng.choice("abé"), word[at] + rng.choice("abé")]) + word[at + 1:]
            words.append(rng.choice([word, word.upper() if word.isascii() else word, word.capitalize()]))
        texts.append((k, " ".join(words)))
    return texts + [(None, "encyclopaedia wonderfull"), (None, None), (1000, ""), (1000, "wonderfull wonderfull"), (1000, "wonderfull")]


@pytest.mark.parametrize("crowd", [20_000, 3])
def test_variants(spark, crowd, monkeypatch):
    monkeypatch.setattr(variants, "CROWD", crowd)
    rows = misspelt(random.Random(crowd))
    docs = frame(spark, rows).selectExpr("*", "'x' AS word", "'x' AS run", "'x' AS mark", "'x' AS id")
    got = variants.variants(variants.words_of(docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == told(counted(rows))
    assert any(r["form"] for r in got) and any(r["root"] not in (r["form"], r["word"]) for r in got)


def test_no_words(empty, docs):
    assert variants.variants(variants.words_of(empty)).count() == 0


def packed(words):
    column = pa.array([w.encode("latin-1") for w in words], pa.binary())
    return textops.flat(column)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcé", min_size=1, max_size=9), min_size=1, max_size=12, unique=True), st.booleans())
def test_near_words_of_a_group(words, long):
    if long:
        words = [w * 12 for w in words]
    data, offsets = packed(words)
    a, b = variants.near(data, offsets, np.zeros(len(words), np.int64))
    got = {frozenset((words[i], words[j])) for i, j in zip(a, b)}
    assert got == {frozenset((x, y)) for x in words for y in words if x < y and one_edit(x, y)}


@settings(max_examples=100, deadline=None)
@given(st.text("abcdeé", min_size=7, max_size=12), st.integers(0, 11), st.sampled_from("abcdeé"), st.integers(0, 2))
def test_one_edit_keeps_a_signature(word, at, letter, kind):
    at %= len(word)
    other = [word[:at] + letter + word[at + 1:], word[:at] + word[at + 1:], word[:at] + letter + word[at:]][kind]
    part = np.random.default_rng(1).integers(0, variants.PARTS, 2048)

    class Words:
        class sparkSession:
            class sparkContext:
                broadcast = staticmethod(lambda value: type("Held", (), {"value": value}))

        @staticmethod
        def mapInArrow(run, schema):
            return run

    run = variants.signed(Words, part)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([w.encode("latin-1") for w in (word, other)], pa.binary()), pa.array([1, 1], pa.int64())], ["word", "n"])
    keys = next(iter(run(iter([batch])))).column(0).to_numpy().reshape(2, -1)
    assert (keys[0] == keys[1]).any()
