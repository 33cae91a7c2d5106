"""Quality score by a sparse ensemble of rules, compiled to one Spark column.

Numbers about each whole text (shares of kinds of bytes, lengths, repeats) feed a small forest;
every path of its trees becomes a conjunctive rule; a lasso logistic regression over the rules
keeps few of them; the kept rules and their weights are one column expression.

Edge cases: null and empty texts have all numbers zero and are scored like any other; repeated
rows score alike; several labels of one document count as the lowest; a null label is none; with
no labels, or labels of one kind only, the score is their mean (0.5 for none); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, textops

LEARN_ROWS = 20_000  # bound of the labelled rows that the trees and weights are fitted on
THRESHOLD = 0.3
TREES, DEPTH, LASSO = 12, 3, 0.001

KINDS = ("other", "lower", "upper", "digit", "blank", "line_end", "stop", "comma", "bang", "bar",
         "sign", "bracket", "lead", "trail")
KIND = np.zeros(256, np.int64)
for _kind, _bytes in {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58),
                      "blank": b" \t\r", "line_end": b"\n", "stop": b".?", "comma": b",;:'\"-()",
                      "bang": b"!", "bar": b"|", "sign": b"#$%&*", "bracket": b"<>[]{}/\\=+_@~^`",
                      "lead": range(192, 256), "trail": range(128, 192)}.items():
    KIND[list(_bytes)] = KINDS.index(_kind)
STATISTICS = (*(f"share_{k}" for k in KINDS), "log_bytes", "word_bytes", "line_words",
              "fresh_words", "fresh_lines", "stop_words", "capital_words")


def _fresh(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Share of distinct values in each text."""
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(firsts) - 1) / np.maximum(np.diff(firsts), 1)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = textops.flat(texts)
    n, size = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(n) * len(KINDS), size)
    kinds = np.bincount(owner + KIND[data], minlength=n * len(KINDS)).reshape(n, len(KINDS))
    out = {f"share_{k}": kinds[:, i] / np.maximum(size, 1) for i, k in enumerate(KINDS)}
    starts, ends, first = textops.spans(data, offsets, textops.NOT_SPACE)
    not_break = np.ones(256, bool)
    not_break[10] = False
    line_from, line_to, line_first = textops.spans(data, offsets, not_break)
    words, lines = np.diff(first), np.diff(line_first)
    out["log_bytes"] = np.log1p(size)
    sums = np.concatenate([[0], np.cumsum(ends - starts)])
    out["word_bytes"] = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(words, 1)
    out["line_words"] = words / np.maximum(lines, 1)
    out["fresh_words"] = _fresh(textops.span_hashes(data, starts, ends), first)
    out["fresh_lines"] = _fresh(textops.span_hashes(data, line_from, line_to), line_first)
    ended = np.concatenate([[0], np.cumsum(KIND[data[ends - 1]] == KINDS.index("stop"))])
    out["stop_words"] = (ended[first[1:]] - ended[first[:-1]]) / np.maximum(words, 1)
    capital = np.concatenate([[0], np.cumsum(KIND[data[starts]] == KINDS.index("upper"))])
    out["capital_words"] = (capital[first[1:]] - capital[first[:-1]]) / np.maximum(words, 1)
    return out


def with_statistics(docs: DataFrame, text: str, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns `keep` and one double for each statistic of the whole text."""
    frames.small_batches(docs.sparkSession)
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    for name in STATISTICS:
        schema = schema.add(prefix + name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            found = statistics(columns[-1])
            yield pa.RecordBatch.from_arrays(
                [*columns[:-1], *(pa.array(found[s], pa.float64()) for s in STATISTICS)],
                [*keep, *(prefix + s for s in STATISTICS)])

    return picked.mapInArrow(frames.lean(run), schema)


def learn_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


@dataclass(frozen=True)
class Rules:
    """Conjunctions of (statistic, is above, bound) with their weights, and the intercept."""

    rules: tuple[tuple[tuple[tuple[int, bool, float], ...], float], ...]
    intercept: float

    def score(self, prefix: str = "") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple[tuple[int, bool, float], ...], prefix: str = "") -> Column:
    out = F.lit(True)
    for at, above, bound in rule:
        name = F.col(prefix + STATISTICS[at])
        out = out & ((name > bound) if above else (name <= bound))
    return out


def paths(node, so_far: tuple = ()) -> Iterator[tuple]:
    """Every path below the root of one tree, inner ones included."""
    if so_far:
        yield so_far
    if node.subtreeDepth() > 0:
        cut = node.split()
        at, bound = cut.featureIndex(), float(cut.threshold())
        yield from paths(node.leftChild(), (*so_far, (at, False, bound)))
        yield from paths(node.rightChild(), (*so_far, (at, True, bound)))


def simplified(path: tuple) -> tuple:
    """One bound for each statistic and side."""
    best: dict[tuple[int, bool], float] = {}
    for at, above, bound in path:
        old = best.get((at, above))
        best[at, above] = bound if old is None else (max(old, bound) if above else min(old, bound))
    return tuple(sorted((at, above, bound) for (at, above), bound in best.items()))


def fit(statistics_table: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Rules:
    """Trees and weights from about `rows` labelled documents of the learning fold, by hash of the id."""
    marked = (labels.where(F.col("quality").isNotNull() & learn_fold(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("_id"))
              .agg(F.min("quality").cast("double").alias("label")))
    known = marked.agg(F.count("*"), F.avg("label")).first()
    if not known[0] or known[1] in (0.0, 1.0):
        mean = 0.5 if not known[0] else min(max(known[1], 0.001), 0.999)
        return Rules((), float(np.log(mean / (1 - mean))))
    scale = 1 << 30
    share = min(scale, int(scale * rows / known[0]))
    marked = marked.where(F.pmod(F.xxhash64("_id"), F.lit(scale)) < share)
    table = frames.written(
        statistics_table.join(marked, F.col("doc_id") == F.col("_id"))
        .select(*STATISTICS, "label"), "quality-learn")
    seen = table.agg(F.count("*"), F.avg("label")).first()
    if not seen[0] or seen[1] in (0.0, 1.0):
        mean = min(max(known[1], 0.001), 0.999)
        return Rules((), float(np.log(mean / (1 - mean))))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features")
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7,
                                    featureSubsetStrategy="0.5").fit(vectors.transform(table))
    rules = sorted({simplified(p) for tree in forest._java_obj.trees()
                    for p in paths(tree.rootNode())})
    if not rules:
        return Rules((), float(np.log(seen[1] / (1 - seen[1]))))
    flags = table.select("label", *[holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))],
                            outputCol="features").transform(flags).select("label", "features")
    frames.release(table.sparkSession)  # either fit runs many jobs with no written table between them
    line = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60,
                              standardization=False).fit(flags)
    frames.release(table.sparkSession)
    kept = tuple((r, float(w)) for r, w in zip(rules, line.coefficients.toArray()) if abs(w) > 1e-9)
    return Rules(kept, float(line.intercept))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Texts are read once."""
    table = frames.written(with_statistics(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", ["doc_id"]), "quality")
    rules = fit(table, labels)
    value = table.withColumn("score", rules.score())
    return value.select("doc_id", F.coalesce(~learn_fold(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@frames.other_columns_aside
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns."""
    learn = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                            "text", ["doc_id"])
    rules = fit(learn, labels)
    wide = with_statistics(docs, "text", docs.columns, "__q_")
    return wide.where(rules.score("__q_") >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score(frames.table(spark, folder, "documents"), frames.table(spark, folder, "labels"))
