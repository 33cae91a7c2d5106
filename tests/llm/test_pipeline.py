"""The pipeline against brute force, stage by stage, and the registered queries' SQL."""

import os
import sys

import brute
import corpus_pipeline
from lastword.llm import catalogue, frames, packing, quality

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    docs = frames.table(spark, FOLDER, "documents")
    items = [(str(r.item_id), r.text) for r in frames.table(spark, FOLDER, "benchmark").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = frames.written(stage(spark, docs, FOLDER), "test-stage")
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if name == "packing":
            pieces = packing.pieces(docs).count()
            assert out.count() == pieces and {r.doc_id for r in out.collect()} == {i for i, _ in before}
            break
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality":
            scores = quality.score(docs, frames.table(spark, FOLDER, "labels")).collect()
            assert set(after) == {r.doc_id for r in scores if r.score >= 0.3}
        elif name == "lines":
            want = brute.kept_lines(before)
            assert {i: t or "" for i, t in after.items()} == {
                i: text for i, (n, gone, text) in want.items() if not n or gone < n}
        elif name == "near_copies":
            assert set(after) == {c for _, _, c in brute.components(before)}
        elif name == "benchmarks":
            assert set(after) == {h[0] for h in brute.hits(before, items) if not h[5]}
        docs = out


def test_stages_on_awkward_tables(spark, docs, repeated, empty):
    for table in (repeated, empty):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = frames.written(stage(spark, now, FOLDER), "test-stage")
            assert now.columns == table.columns
        corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).count()


def test_sql(spark):
    db = compare.database(FOLDER)
    for name in catalogue.SQL:
        assert compare.compare(spark, db, FOLDER, name)[1] is None
