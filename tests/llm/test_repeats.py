"""Suffix dedup and line dedup against brute force."""

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from docketeer.llm import lines, queries, repeats, suffixes
from tests.conftest import DATA


def brute_passages(docs, length=50):
    words = sorted({(d, t or "") for d, t in docs if d is not None})
    places = defaultdict(list)
    for d, t in words:
        w = re.findall(r"[^ \t-\r]+", t)
        for s in range(len(w) - length + 1):
            places[tuple(w[s : s + length])].append((d, s))
    spans, removed = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for k, (d, s) in enumerate(sorted(found)):
                spans[d].update(range(s, s + length))
                if k:
                    removed[d].update(range(s, s + length))
    return spans, removed


def covered(text):
    return {i for part in filter(None, text.split(",")) for i in range(*map(int, part.split(":")))}


def test_passages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op1_suffix_dedup(spark, DATA).collect()}
    spans, removed = brute_passages([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {d: covered(r["spans"]) for d, r in found.items()} == spans
    assert {d: covered(r["removed"]) for d, r in found.items() if r["removed"]} == removed


def test_passages_over_many_ranges(spark):
    """Short windows over few words, so that suffixes alike on the right alone lie between matches and equal contexts
    run over the ends of ranges; a passage that a third of the documents share; repeated rows."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        words = [f"w{x}" for x in rng.integers(0, 5 if i % 2 else 300, rng.integers(0, 40))]
        rows.append((i, " ".join(words + (["hot"] * 2 + [f"p{k}" for k in range(9)] if i % 3 == 0 else []) + words[:7])))
    rows += rows[:5] + [(900 + i, t) for i, (_, t) in enumerate(rows[10:30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffixes.repeated_passages(docs, length=6, gram=3).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    cover = lambda spans: {i for x in spans for i in range(x["start"], x["end"])}
    spans, removed = brute_passages(rows, 6)
    assert {r["doc_id"]: cover(r["spans"]) for r in found} == spans
    assert {r["doc_id"]: cover(r["removed"]) for r in found if r["removed"]} == removed


def test_neighbours_across_ranges(spark):
    """Every row is a range of its own, or nearly: the ends of ranges settle what is repeated."""
    rows = [(k, i) for i, k in enumerate([1, 1, 1, 2, 3, 3, 4, None, None, 5])] + [(3, 4)]
    df = spark.createDataFrame(rows, "k long, place long")
    for n in (1, 3, 11):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            found = suffixes.with_edges(suffixes.compared(df.where("k is not null"), ["k"], ["place"]), ["k"], ["place"])
            assert sorted(map(tuple, found.collect())) == [(0, False), (1, True), (2, True), (4, False), (5, True)]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_passages_of_odd_rows(odd_docs, no_docs):
    found = {r["doc_id"]: r for r in suffixes.document_passages(odd_docs).collect()}
    assert set(found) == {1, 2, 3, 4}
    assert covered(found[1]["spans"]) == set(range(80, 140)) and found[1]["removed"] == "" and covered(found[2]["removed"]) == set(range(80, 140))
    assert found[4]["copy_of"] == 3 and covered(found[4]["removed"]) == set(range(200)) and found[3]["removed"] == ""
    assert suffixes.document_passages(no_docs).count() == 0
    cleaned = suffixes.remove_repeats(odd_docs, suffixes.repeated_passages(odd_docs))
    assert cleaned.columns == odd_docs.columns and cleaned.count() == odd_docs.count()
    text = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert text[4] == "" and len(text[2].split()) == 160 and len(text[1].split()) == 220


def test_selection_finds_every_repeat():
    rng = np.random.default_rng(0)
    for _ in range(50):
        passage = rng.integers(0, 2**63, 50).astype(np.uint64)
        docs = [np.concatenate([rng.integers(0, 2**63, rng.integers(0, 40)).astype(np.uint64), passage, rng.integers(0, 2**63, rng.integers(0, 40)).astype(np.uint64)]) for _ in range(2)]
        seeds = []
        for units in docs:
            grams, chosen = repeats.selected(units, 50, 25)
            seeds.append(set(grams[np.unique(chosen)].tolist()))
        assert seeds[0] & seeds[1]


def test_word_hashes_see_words_alone():
    one, two = repeats.hash_words(b"  the cat\tsat\n"), repeats.hash_words(b"the\x0bcat sat")
    assert one.tolist() == two.tolist() and len(set(one.tolist())) == 3
    assert repeats.hash_words(b"").tolist() == [] == repeats.hash_words(b" \n ").tolist()


def test_lines_equal_sql(same_rows):
    same_rows(queries.op8_line_dedup, lines.ORACLE_SQL)


def test_lines_of_odd_rows(odd_docs, no_docs):
    out = lines.dedup_lines(odd_docs)
    assert out.count() == odd_docs.count() and out.columns == [c for c in odd_docs.columns if c != "n_lines"] + ["n_lines", "n_deleted"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[11]["text"] == "other\nline four" and rows[11]["n_deleted"] == 3 and rows[10]["n_deleted"] == 0
    assert rows[5]["text"] is None and rows[7]["text"] == "   \n\t " and rows[1]["n_deleted"] == 0
    kept = lines.keep_lines(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert lines.dedup_lines(no_docs).count() == 0


def test_runs_delete_later_lines(spark):
    docs = spark.createDataFrame([(1, "a\na\na\na\na"), (2, "x\nb\nc\nd\ne\ny"), (3, "b\nc\nd\ne"), (4, "c\nd")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    assert out == {1: "a", 2: "x\nb\nc\nd\ne\ny", 3: "", 4: "c\nd"}
    assert sorted(r["doc_id"] for r in lines.keep_lines(docs).select("doc_id").collect()) == [1, 2, 4]
    assert docs.select(F.count("*")).first()[0] == 4
