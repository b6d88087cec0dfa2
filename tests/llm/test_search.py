"""Ranked search against the score's definition, document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docketeer.llm import queries, search
from docketeer.llm.common import shared_path

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """docs, items: (key, text) rows.  (item, rank, doc, score) rows."""
    held = [(key, Counter(terms(t))) for key, t in docs]
    full = [(key, c) for key, c in held if c]
    n_docs, n_terms = len(full), sum(sum(c.values()) for _, c in full)
    df = Counter(t for _, c in full for t in c)
    out = []
    for item, text in items:
        found = []
        for key, c in full:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if none else key, -score) for i, (score, none, key) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=10):
    path = shared_path(spark, "index")
    search.build_index(docs, path)
    return sorted((tuple(r) for r in search.search(spark.read.parquet(path), items, k).collect()), key=str)


def test_documents_equal_sql(same_rows):
    same_rows(queries.op12_ranked_search, search.ORACLE_SQL)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_equal_brute_force(spark, monkeypatch, seed):
    """Few words, so that scores tie; blocks of few documents; queries in several groups."""
    monkeypatch.setattr(search, "QUERIES_TOGETHER", 7)
    monkeypatch.setattr(search, "BLOCK_DOCS", 5)
    rng = random.Random(seed)
    words = ["Ab", "ab", "é", "É", "x1", "don't", "ß-ß", "日本", "zz", *(f"w{i}" for i in range(40))]
    text = lambda most: " ".join(rng.choice(words) for _ in range(rng.randrange(most)))
    docs = [(i, text(60)) for i in range(400)] + [(500 + i, "w1 w2 w3") for i in range(60)] + [(None, "w1 w2 w3 w4 w4")]
    items = [(i, text(12)) for i in range(25)] + [(90, ""), (91, None), (92, "unheard of"), (93, "w1 w1 w1 w2"), (93, "w1 w1 w1 w2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert ranked(spark, frame, spark.createDataFrame(items, "item_id long, text string"), 3) == brute(docs, items, 3)


def test_large_weights_stay_exact(spark):
    docs = [(i, f"a b{i % 7} c{i}") for i in range(50)]
    items = [(1, "c3 b3 " * 700_000), (2, "a b1")]
    assert ranked(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_bounds_hold_for_every_document():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 80))).encode() for _ in range(64)]
    batch = pa.RecordBatch.from_pylist([search.block_of(texts)])
    asked = search.Queries([b"w1 w2 w3", b"w5 w5 w29", b"none"])
    asked.weigh(64, batch.column("n_terms")[0].as_py(), {i: 9 for i in range(len(asked.names))})
    block = search.Block(batch, 0, pa.array(asked.names, pa.binary()))
    scores = block.scores(asked, np.arange(3))
    assert scores.shape == (64, 3) and (scores <= block.bounds(asked)).all() and scores.max() > 0 and not scores[:, 2].any()


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "motion12 court7 hearing3 LINE one"), (2, None), (3, "a b c")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert ranked(spark, odd_docs, asked) == brute(docs, items)
    assert ranked(spark, no_docs, asked) == [] and ranked(spark, odd_docs, asked.limit(0)) == []


def test_keys_may_be_text(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "id string, body string")
    path = shared_path(spark, "index")
    search.build_index(docs, path, "id", "body")
    found = search.search(spark.read.parquet(path), spark.createDataFrame([("q", "x")], "name string, ask string"), 10, "name", "ask")
    assert [(r["name"], r["rank"], r["key"]) for r in found.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]
