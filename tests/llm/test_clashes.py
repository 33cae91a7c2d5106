"""Columns of the caller that are called like the helper columns of a stage."""

import pytest
from conftest import frame, prose
from lastword.llm import decontaminate, frames, jaccard, lines
from pyspark.sql import functions as F

NAMES = ["__id", "__hash", "__i", "__lines", "__n_lines", "_i", "_h", "__bad_key", "__text", "__q_log_bytes", "key", "one",
         "two", "size", "Text", "with.dot", "caller column 0"]


def clashing(spark):
    import random
    rng = random.Random(8)
    base = prose(rng, 60)
    rows = [(1, base), (2, base + " more"), (3, prose(rng, 30) + "\n" + base), (4, None), (5, "short one")]
    docs = frame(spark, rows, clashes=False)
    plain = docs.toDF(*docs.columns)
    return plain, docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def of_row(row, columns):
    return {name: row[k] for k, name in enumerate(columns)}


@pytest.mark.parametrize("stage", ["keep_one", "without_repeats", "drop_contaminated"])
def test_columns_of_the_caller_come_back_as_they_are(spark, stage):
    plain, docs = clashing(spark)
    items = spark.createDataFrame([("a", " ".join(prose(__import__("random").Random(8), 60).split()))], "item_id string, text string")
    run = {"keep_one": jaccard.keep_one, "without_repeats": lines.without_repeats,
           "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, items)}[stage]
    want = {r["doc_id"]: r["text"] for r in run(plain).collect()}
    out = run(docs)
    assert out.columns == docs.columns
    found = [of_row(r, out.columns) for r in out.collect()]
    assert {r["doc_id"]: r["text"] for r in found} == want and 0 < len(want)
    assert all(r[name] == f"{name} of {r['doc_id']}" for r in found for name in NAMES)


def test_a_stage_sees_no_name_of_the_caller(spark):
    _, docs = clashing(spark)
    seen = []
    out = frames.other_columns_aside(lambda d: seen.extend(d.columns) or d.withColumn("__id", F.lit(1)).drop("__id"))(docs)
    assert out.columns == docs.columns and not set(seen) & set(NAMES[:-1])
