"""Small awkward tables for all operators."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
FOLDER = "/root/testdata/sf0.001"
CLASHES = ["size", "one", "part", "token", "class", "n", "owner", "spans", "key", "first", "__n"]


def prose(rng, words):
    out = []
    for _ in range(words):
        out.append("".join(rng.choice("abcdeilnorstué") for _ in range(rng.randint(2, 8))))
    lines = [" ".join(out[i:i + 17]) for i in range(0, len(out), 17)]
    return "\n".join(lines)


def awkward():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, copies, near copies,
    shared lines and passages, periodic text."""
    rng = random.Random(4)
    base = prose(rng, 120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, base), (8, base)]
    for i in range(9, 33):  # near copies of one text, more than a short list
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    passage = prose(rng, 60)
    rows += [(i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30)) for i in range(33, 45)]
    rows += [(45, "a" * 201), (46, "a" * 199), (47, "ab " * 900), (48, prose(rng, 9000)), (49, "\n\n" + passage + "\n"),
             (50, "Ünïcode Ça va? " * 3), (51, "x\ny\nx\ny"), (52, "<|endoftext|> don't we'LL 12 ³ ﬁ\u0301")]
    rows += [(53, base.upper())]
    return rows


REPEATED = [(60, "the very same row twice over and over again it goes"), (None, "no id at all but the text is here"),
            (None, None)]


def frame(spark, rows, clashes=True, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df


@pytest.fixture(scope="session")
def rows():
    return awkward()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def repeated(spark, rows, tmp_path_factory):
    """The awkward table with repeated rows and null ids."""
    path = str(tmp_path_factory.mktemp("docs") / "repeated.parquet")
    frame(spark, rows[:12] + REPEATED * 2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
