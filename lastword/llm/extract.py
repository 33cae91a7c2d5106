"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks. Each is read as hashed parts of its tag path, hashed words
and a few numbers; a bidirectional LSTM labels every block with the whole page as context. It is
trained anew on a bounded sample of pages: their blocks with weak labels from the names of elements
and classes, and pages composed of the same texts in other structures, whose labels are known.

Edge cases: null and empty pages have empty text; repeated rows give equal rows; null ids and urls stay
null; with no pages to learn from, the weak labels alone decide; an empty table gives no rows; other
columns are ignored. Tags that are cut off or have open quotes are skipped.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import blstm, frames, textops
from lastword.llm.pages import Leaf, leaves

LEARN_PAGES = 280  # bound of the sample; as many composed pages are added
LEARN_BLOCKS = 60  # of a page in training; labelling reads all blocks
ROUNDS, GROUP = 14, 16
NUMBERS = 8

# Element and class names that weak labels and composed pages go by.
ASIDE_TAGS = ("nav", "header", "footer", "aside", "form", "button", "dialog")
ASIDE_NAMES = ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "sidebar", "widget",
               "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar",
               "cookie", "cookies", "notice", "consent", "popup", "modal", "overlay", "newsletter", "subscribe",
               "signup", "share", "social", "related", "recommended", "comment", "comments", "reply", "respond",
               "discussion", "login", "search", "copyright", "legal", "disclaimer", "pagination", "pager", "toolbar",
               "complementary", "contentinfo", "alert", "gdpr", "teaser", "trending")
MAIN_TAGS = ("article", "main")
MAIN_NAMES = ("content", "post", "entry", "article", "body", "story", "text", "main", "page", "prose", "single")
CONTENT_TAGS = ("p", "p", "p", "p", "h2", "h3", "li", "blockquote", "pre", "td", "dd", "figcaption", "div")


def weak(leaf: Leaf) -> bool:
    """What names say of a block; where they say nothing, whether it reads like prose."""
    if any(x in ASIDE_TAGS or x[0] == "." and x[1:] in ASIDE_NAMES for x in leaf.path):
        return False
    if any(x in MAIN_TAGS or x[0] == "." and x[1:] in MAIN_NAMES for x in leaf.path):
        return True
    return leaf.linked < 0.3 and ("p" in leaf.path or leaf.text.count(" ") >= 10)


def shortened(text: str, rng: random.Random) -> str:
    words = text.split()
    at = rng.randrange(len(words))
    return " ".join(words[at:at + rng.randint(1, 3)])


def composed(texts: list[str], others: list[str], rng: random.Random) -> tuple[str, list[str]]:
    """A page of other structure: its html and the main blocks in order."""
    def aside(text: str) -> str:
        text, name = escape(text), rng.choice(ASIDE_NAMES)
        kind = rng.random()
        if kind < 0.3:
            tag = rng.choice(ASIDE_TAGS[:5])
            inner = rng.choice((f"<p>{text}</p>", f"<ul><li><a href='/x'>{text}</a></li></ul>", text,
                                f"<div>{text}</div>", f"<h1>{text}</h1>",
                                f"<h2>{text}</h2>"))
            return f"<{tag}>{inner}</{tag}>"
        if kind < 0.5:
            items = "".join(f"<li><a href='/{k}'>{escape(w)}</a></li>" for k, w in enumerate(text.split()[:6]))
            return f"<div class='{name}'><ul>{items or text}</ul></div>"
        tag = rng.choice(("div", "section", "ul", "p", "div"))
        inner = rng.choice((f"<p>{text}</p>", text, f"<div>{text}</div>", f"<h3>{text}</h3><p>{text}</p>"))
        key = rng.choice(("class", "id"))
        return f"<{tag} {key}='{name}{rng.choice(('', '-box', ' block', '-list', '_area'))}'>{inner}</{tag}>"

    pick = lambda: rng.choice(others if rng.random() < 0.5 else texts)
    main, blocks = [], []
    for k, text in enumerate(texts):
        if rng.random() < 0.2:  # short blocks, which only their place tells from menus
            text = shortened(text, rng)
        tag = "h1" if k == 0 and rng.random() < 0.7 else rng.choice(CONTENT_TAGS)
        main.append(f"<{tag}>{escape(text)}</{tag}>")
        blocks.append(text)
        if rng.random() < 0.08:
            main.append(aside(pick()))
    kind = rng.random()
    box = (("<article>", "</article>") if kind < 0.35 else ("<main>", "</main>") if kind < 0.5 else
           (f"<div class='{rng.choice(MAIN_NAMES)}{rng.choice(('', '-area', ' wide', '-inner'))}'>", "</div>")
           if kind < 0.85 else ("<div>", "</div>"))
    before = "".join(aside(pick()) for _ in range(rng.randint(0, 4)))
    after = "".join(aside(pick()) for _ in range(rng.randint(0, 5)))
    inside = "".join(aside(pick()) for _ in range(rng.randint(0, 2)))
    return f"<html><body>{before}{box[0]}{''.join(main)}{inside}{box[1]}{after}</body></html>", blocks


def numbers(page: list[Leaf]) -> np.ndarray:
    out = np.zeros((len(page), NUMBERS), np.float32)
    for k, leaf in enumerate(page):
        words = leaf.text.count(" ") + 1
        size = len(leaf.text)
        out[k] = (np.log1p(words) / 4, leaf.linked, leaf.text.count(".") / words,
                  leaf.text.count(",") / words, leaf.text[-1] in ".!?:\"'", size / words / 10,
                  k / len(page), 1.0 if k == 0 else 0.0)
    return out


def described(page: list[Leaf]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Numbers, path buckets and word buckets of each block."""
    paths = []
    for leaf in page:
        seen = dict.fromkeys((*leaf.path, ">" + (leaf.path[-1] if leaf.path else "")))
        paths.append(np.array([zlib.crc32(x.encode()) % blstm.PATHS for x in seen], np.int64))
    data, offsets = textops.flat(pa.array([x.text for x in page], pa.string()))
    starts, ends, first = textops.spans(textops.LOWER[data], offsets, textops.NOT_SPACE)
    hashes = (textops.span_hashes(textops.LOWER[data], starts, ends) % np.uint64(blstm.WORDS)).astype(np.int64)
    return numbers(page), paths, np.split(hashes, first[1:-1])


def batch_of(pages: list[tuple]) -> blstm.Batch:
    steps, width = max(len(p[0]) for p in pages), len(pages)
    table = np.zeros((steps, width, NUMBERS), np.float32)
    mask = np.zeros((steps, width), np.float32)
    at: tuple[list, list] = ([], [])
    for b, (values, *buckets) in enumerate(pages):
        table[:len(values), b] = values
        mask[:len(values), b] = 1
        for kind in (0, 1):
            size = np.array([len(x) for x in buckets[kind]], np.int64)
            where = np.repeat(np.arange(len(values)) * width + b, size)
            at[kind].append(np.stack([where, np.concatenate(buckets[kind])], 1))
    joined = [np.concatenate(x) for x in at]
    return blstm.Batch(table, *(x[np.argsort(x[:, 0], kind="stable")] for x in joined), mask)


def learn(pages: list[list[Leaf]], seed: int = 11) -> blstm.Labeller | None:
    """A labeller from weak labels of the pages and from composed ones."""
    pages = [p[:LEARN_BLOCKS] for p in pages if p]
    if not pages:
        return None
    rng = random.Random(seed)
    examples = [(p, [weak(x) for x in p]) for p in pages]
    # The same pages with many blocks cut to few words: length must not outweigh place.
    for p, labels in list(examples):
        examples.append(([Leaf(x.path, shortened(x.text, rng) if rng.random() < 0.5 else x.text, x.linked)
                          for x in p], labels))
    asides = [x.text[:300] for p in pages for x in p if not weak(x)] or ["Home", "About us"]
    for p in pages:
        texts = [x.text[:2000] for x in p if weak(x)][:LEARN_BLOCKS // 2]
        if not texts:
            continue
        rng.shuffle(texts)
        html, blocks = composed(texts[:rng.randint(1, len(texts))], asides, rng)
        found = leaves(html)
        # A main block is told from an aside of the same text by its path.
        examples.append((found, [x.text in blocks and not any(
            y in ASIDE_TAGS or y[0] == "." and y[1:] in ASIDE_NAMES for y in x.path) for x in found]))
    examples = sorted(((p[:LEARN_BLOCKS], y[:LEARN_BLOCKS]) for p, y in examples if p), key=lambda e: len(e[0]))
    batches = []
    for low in range(0, len(examples), GROUP):
        part = examples[low:low + GROUP]
        batch = batch_of([described(p) for p, _ in part])
        labels = np.zeros(batch.mask.shape, np.float32)
        for b, (_, y) in enumerate(part):
            labels[:len(y), b] = y
        batches.append((batch, labels))
    model = blstm.Labeller(NUMBERS, seed)
    model.fit(batches, ROUNDS)
    return model


def main_blocks(pages: list[list[Leaf]], model: blstm.Labeller | None) -> list[list[str]]:
    if model is None:
        return [[x.text for x in p if weak(x)] for p in pages]
    out: list[list[str]] = [[] for _ in pages]
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    low = 0
    while low < len(order):
        # Pages of like length together, so that padding stays small.
        high = low + 1
        while high < len(order) and high - low < 64 and len(pages[order[high]]) * (high - low) <= 4096:
            high += 1
        part = order[low:high]
        logits, _ = model.forward(batch_of([described(pages[k]) for k in part]))
        for b, k in enumerate(part):
            out[k] = [x.text for x, score in zip(pages[k], logits[:, b]) if score > 0]
        low = high
    return out


def sample(pages: DataFrame, rows: int = LEARN_PAGES) -> list[list[Leaf]]:
    """Blocks of about `rows` pages, by hash of the id; at most LEARN_BLOCKS of 4,000 characters each."""
    n = pages.count()
    if not n:
        return []
    scale = 1 << 30
    share = min(scale, scale * rows // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(x.path, x.text[:4000], x.linked) for x in leaves(page or "")[:LEARN_BLOCKS]]
                     for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[{"path": list(p), "text": t, "linked": x} for p, t, x in page] for page in found],
                          pa.list_(pa.struct([("path", pa.list_(pa.string())), ("text", pa.string()),
                                              ("linked", pa.float64())])))], ["blocks"])

    picked = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(scale)) < share).select("html")
    rows_ = picked.mapInArrow(run, "blocks array<struct<path:array<string>,text:string,linked:double>>")
    return [[Leaf(tuple(x["path"]), x["text"], x["linked"]) for x in r["blocks"]] for r in rows_.take(2 * rows)]


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    frames.small_batches(spark)
    model = spark.sparkContext.broadcast(learn(sample(pages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = main_blocks([leaves(page or "") for page in batch.column(2).to_pylist()], model.value)
            texts = ["\n".join(x).encode("utf-8", "replace").decode() for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")


def op3_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract(frames.table(spark, folder, "pages"))
