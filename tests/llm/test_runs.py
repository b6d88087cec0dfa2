"""Periodic runs against the definition, place by place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from docketeer.llm import queries, runs
from tests.conftest import DATA


def brute_runs(words):
    """Every maximal stretch of each period, with the smallest period of each."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # periods ascend
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *row, digest("".join(f"{s},{k},{q}\n" for s, k, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic(rng):
    """Words of few kinds, with repeated stretches and repeated stretches of repeated stretches."""
    out = []
    while len(out) < rng.randrange(0, 120):
        part = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        for _ in range(rng.randrange(0, 2)):
            part = part * rng.randrange(1, 5) + [rng.choice("abc")]
        out += part * rng.randrange(1, 8) + [rng.choice("abcdef") for _ in range(rng.randrange(0, 3))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_words_equal_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(runs, "MANY", 1)
    texts = [periodic(rng) for _ in range(120)] + [["a"] * n for n in range(14)] + [[], ["a", "b"] * 40, list("ab") * 3, list("aab") * 4]
    assert [sorted(r) for r in runs.find_runs(texts)] == [brute_runs(t) for t in texts]


def test_z_function():
    rng = random.Random(5)
    for n in [0, 1, 2, *range(3, 60)]:
        w = [rng.choice("ab") for _ in range(n)]
        assert runs.z_function(w) == [next((k for k in range(n - i) if w[k] != w[i + k]), n - i) for i in range(n)]


def test_one_word_many_times_takes_no_long():
    assert runs.find_runs([["a"] * 300_000, ["b"] * 5]) == [[(0, 300_000, 1)], []]


def test_documents_equal_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    out = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, DATA).collect())
    assert out == sorted(brute(r["doc_id"], r["text"]) for r in rows)
    assert sum(r[1] > 0 for r in out) > len(out) / 20


def test_odd_rows(spark, odd_docs, no_docs):
    out = sorted((tuple(r) for r in runs.document_runs(odd_docs).collect()), key=str)
    short = [r for r in odd_docs.select("doc_id", "text").collect() if len(r["text"] or "") < 50_000]
    expected = sorted((brute(r["doc_id"], r["text"]) for r in short), key=str)
    assert [r for r in out if r[0] != 8] == expected and len(out) == odd_docs.count()
    assert runs.document_runs(no_docs).count() == 0


def test_mark_runs_keeps_texts(spark):
    rows = [(1, "x a b a b a b a b y"), (2, None), (3, " \t "), (4, "w w w w w w w w"), (4, "w w w w w w w w")]
    out = [tuple(r) for r in runs.mark_runs(spark.createDataFrame(rows, "k int, body string"), "k", "body").collect()]
    assert [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in sorted(out, key=lambda r: r[0])] == [
        (1, 10, [(1, 8, 2)], "x a b y"), (2, 0, [], ""), (3, 0, [], ""),
        (4, 7, [(0, 6, 1)], "w w w"), (4, 7, [(0, 6, 1)], "w w w"),
    ]
