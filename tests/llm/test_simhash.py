"""SimHash fingerprints, anchors and components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from docketeer.llm import queries, simhash
from docketeer.llm.components import components
from tests.conftest import DATA


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(items):
    """items (id, fingerprint) to the smallest id reachable over at most 4 bits."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    bits = np.array([f for _, f in items], np.uint64)
    for i in range(len(items)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 4).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(items):
        low[find(i)] = min(d, low.get(find(i), d))
    return {d: low[find(i)] for i, (d, _) in enumerate(items)}


def test_documents_equal_brute_force(spark):
    docs = [(r["doc_id"], brute(r["text"])) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op10_simhash(spark, DATA).collect()}
    expected = reach(docs)
    assert out == {d: (f"{f:016x}", expected[d]) for d, f in docs}


def test_anchors_are_all_code_words_within_two():
    rng = np.random.default_rng(0)
    values = np.append(rng.integers(0, 1 << 31, 200), [0, (1 << 31) - 1])
    rows, words = simhash.anchors(values)
    assert not simhash.syndromes(words).any() and set(np.bitwise_count((values[rows] ^ words).astype(np.uint64)).tolist()) <= {0, 1, 2}
    assert set(np.bincount(rows, minlength=len(values)).tolist()) <= {1, 16}
    for _ in range(300):
        x = int(rng.integers(0, 1 << 31))
        a, b = rng.choice(31, 2, replace=False)
        pair = np.array([x, x ^ (1 << int(a)) ^ (1 << int(b))])
        r, w = simhash.anchors(pair)
        assert set(w[r == 0].tolist()) & set(w[r == 1].tolist())


@pytest.mark.parametrize("bucket", [4096, 16])
def test_links_reach_what_all_pairs_reach(spark, bucket):
    rng = np.random.default_rng(3)
    found = set()
    for center in rng.integers(-(2**63), 2**63, 5):
        for _ in range(80):
            value = int(np.array([center]).view(np.uint64)[0])
            for bit in rng.integers(0, 64, rng.integers(0, 7)):
                value ^= 1 << int(bit)
            found.add(value)
    items = [(i, f) for i, f in enumerate(sorted(found))]
    signed = [(int(np.array([f], np.uint64).view(np.int64)[0]),) for _, f in items]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), bucket)
    number = {s[0]: i for i, s in enumerate(signed)}
    joined = {r["node"]: r["component"] for r in components(links).collect()}
    classes = {}
    for s, i in number.items():
        classes.setdefault(joined.get(s, s), []).append(i)
    assert {i: min(c) for c in classes.values() for i in c} == reach(items)


def test_long_chains_converge(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 901)], "a long, b long")
    out = {r["node"]: r["component"] for r in components(chain).collect()}
    assert set(out[i] for i in range(201)) == {0} and out[901] == 900 and 500 not in out


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in simhash.document_components(odd_docs).collect()]
    by = {r[0]: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert by[5][1] == by[6][1] == by[7][1] == "0" * 16 and by[5][2] == 5 and by[7][2] == 5
    assert by[4][2] == 3 and by[8][2] == 8
    assert simhash.document_components(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and 4 not in {r["doc_id"] for r in kept.collect()}


def test_keep_one_by_row(spark, odd_docs):
    """A null doc_id that is near no other stays, and texts that share a doc_id are judged one by one."""
    kept = simhash.keep_one(odd_docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and ids.count(12) == 1 and 6 not in ids and 7 not in ids
    texts = [" ".join(f"w{(i * 7919 + j * j) % 10_007}" for j in range(60)) for i in (1, 2, 3)]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (None, texts[1]), (None, texts[2]), (None, None), (3, ""), (None, texts[2])]
    out = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(out, key=str) == sorted([(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, "")], key=str)
