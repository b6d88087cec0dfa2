"""The pipeline against its stages worked out one by one in plain Python."""

import hashlib
from collections import defaultdict

import corpus_pipeline
from docketeer.llm import mixing, pieces, quality
from docketeer.llm.queries import PIECES
from tests.conftest import DATA
from tests.llm.test_simhash import brute, reach
from tests.llm.test_texts import best_score, piece_scores, score_of


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {r["doc_id"] for r in quality.document_verdicts(docs, spark.read.parquet(f"{DATA}/labels.parquet")).where("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}

    filled = {d: [x.strip(" \t\x0b\x0c\r") for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")] for d, t in texts.items()}
    seen, gone = set(), defaultdict(set)
    for d in sorted(filled):
        for s in range(len(filled[d]) - 2):
            key = tuple(filled[d][s : s + 3])
            if key in seen:
                gone[d].update(range(s, s + 3))
            seen.add(key)
    after = {}
    for d, t in texts.items():
        number, out = 0, []
        for line in t.split("\n"):
            if line.strip(" \t\x0b\x0c\r"):
                out += [line] if number not in gone[d] else []
                number += 1
            else:
                out.append(line)
        if not gone[d] or len(gone[d]) < number:
            after[d] = "\n".join(out)
    classes = reach(sorted((d, brute(t)) for d, t in after.items()))
    single = {d: t for d, t in after.items() if classes[d] == d}

    rows = spark.createDataFrame([(r["doc_id"], single[r["doc_id"]], r["lang"], r["source"], r["n_chars"]) for r in docs.collect() if r["doc_id"] in single], docs.schema)
    chosen = {r["doc_id"] for r in mixing.document_mix(rows).where("chosen").collect()}
    found = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"] for r in found} == chosen and len(found) == len(chosen)
    assert all(r["round_trip"] for r in found) and 0 < len(found) < len(texts)
    vocabulary = pieces.load_vocabulary(PIECES)
    scores = piece_scores(vocabulary)
    longest = max(len(t) for t in scores if t)
    for r in found:
        text = single[r["doc_id"]]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["n_tokens"] == len(r["ids"])
        assert abs(score_of(r["ids"], vocabulary) - best_score(text, scores, longest)) < 1e-6


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns
    assert corpus_pipeline.STAGES[1][1](spark, docs.limit(0), DATA).count() == 0
