"""PII, toxicity, quality rules, tokens, pieces and TIFF: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketeer.llm import boosting, mixing, pieces, pii, quality, queries, tiff, token_files, toxicity
from tests.conftest import DATA

MODEL, TOKENS = queries.PIECES, queries.WORD_IDS


def brute_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        out += [(2, m.start(), m.end())] if 13 <= len(digits) <= 19 and pii.luhn(digits) else []
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(0)
    for _ in range(20_000):
        text = "".join(rng.choice(["a", "@", ".", "0", "12", "255", "256", "0001", "+", "(", " ", "-", "b.c", "4", "1"]) for _ in range(rng.randrange(1, 40)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_numbers_that_touch_are_one_match():
    """With nothing but spaces between them a phone, a card and an address are one match of too many digits each."""
    text = "a.b@c.de +1 (229) 555-4838 4046195599780836 10.0.0.1"
    assert pii.base_spans(text) == brute_spans(text) and [k for k, _, _ in pii.base_spans(text)] == [0, 1]


def test_base_spans_of_hostile_texts():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" * 100_000, "a@" * 100_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in queries.op3_pii(spark, DATA).collect():
        base = brute_spans(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_pii_model_adds_other_formats(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        text = " ".join(rng.choice(["alpha", "beta", "gamma", "17", "3.5", "2024-01-02"]) for _ in range(30))
        mail = f"{rng.choice('abcde')}{i}.x@mail{i % 9}.example.com"
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"{text} {mail} {text} {phone} {text}" if i % 2 else text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    found = model.added(["write to bob.y [at] mail7[dot]example[dot]com now", "count 17 of 2024-01-02 and 3.5"], [[], []])
    assert [s[0] for s in found[0]] == [0] and found[1] == []
    assert pii.redact("call +1 229 555 4838 now", [(3, 5, 20)]) == "call [phone] now"


def own_forms(rng):
    """(kind, value) in ways that the base rules don't take, written apart from the model's own generators."""
    name = lambda: "".join(rng.choice("abdefgiklmnoprstuv") for _ in range(rng.randrange(4, 9)))
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
    card = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
    part = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    return [
        (0, f"{name()}.{name()} [at] {name()}.org"), (0, f"{name()}(at){name()}(dot)com"), (0, f"{name()}{rng.randrange(99)} at {name()} dot net"),
        (1, "-".join(str(rng.randrange(256)) for _ in range(4))), (1, ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8))),
        (2, "/".join(card[i : i + 4] for i in range(0, 16, 4))), (2, ".".join(card[i : i + 4] for i in range(0, 16, 4))),
        (3, f"({part(3)}) {part(3)}-{part(4)}"), (3, f"{part(3)}.{part(3)}.{part(4)}"), (3, f"{part(3)}-{part(3)}-{part(4)}"),
    ]


def own_decoys(rng):
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(15))
    wrong = next(digits[:-1] + c for c in "0123456789" if not pii.luhn(digits[:-1] + c))
    return [wrong, " ".join(wrong[i : i + 4] for i in range(0, 16, 4)), "/".join(wrong[i : i + 4] for i in range(0, 16, 4)), f"{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", f"{rng.randrange(1, 9)}.{rng.randrange(1, 9)}.{rng.randrange(1, 9)}", f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}"]


def test_pii_adds_what_is_hidden_and_nothing_else(spark):
    """Forms and decoys of the test's own, and the model's, in all documents: recall by kind, and every span that is
    added beside them counts as wrong, whether it stood in the document before or not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.train(docs)
    assert all(t <= 1 for t in model.thresholds)
    right, wrong, total, rng = Counter(), [], Counter(), random.Random(8)
    for r in docs.collect():
        text, truth, _ = pii.planted(r["text"] or "", 1_000_003 * r["doc_id"] + 17)
        (kind, value), decoy = rng.choice(own_forms(rng)), rng.choice(own_decoys(rng))
        start = len(text) + len(" and ") + len(decoy) + 5
        text = f"{text} and {decoy} and {value} ende"
        truth = [*truth, (kind, start, start + len(value))]
        base = pii.base_spans(text)
        found = model.added([text], [base])[0]
        assert not any(b[1] < s[2] and s[1] < b[2] for s in found for b in base)
        wrong += [text[s[1] : s[2]] for s in found if not pii._matches(s, truth)]
        for span in truth:
            total[span[0]] += 1
            right[span[0]] += pii._matches(span, found + base)
    assert all(right[k] / total[k] > 0.9 for k in range(4)), (right, total)
    assert len(wrong) <= 0.02 * sum(right.values()), wrong
    rows = pii.find(docs, model).where("n_added > 0").collect()
    assert not rows, "the table holds no hidden forms, and sixteen digits with a wrong check digit are nobody's card"


def test_pii_candidates_without_limits():
    """Long local parts and long runs of numbers are whole, and windows of a long run start at each of its numbers."""
    text = "x" * 300 + " [at] host.example"
    assert (0, 0, len(text)) in pii.candidates(text)
    run = " ".join(str(1000 + i) for i in range(500))
    found = pii.candidates(run)
    starts = {s[1] for s in found if s[0] == 2}
    assert {run.index(str(1000 + i)) for i in range(490)} <= starts and all(len([c for c in run[a:b] if c.isdigit()]) <= 20 for _, a, b in found)
    for text in ("1" * 200_000, "1 " * 100_000, "+(" * 100_000, "a at b dot " * 20_000):
        pii.candidates(text)


def test_pii_training_is_bounded_by_rows(spark):
    rows = [(1, "write to a1 [at] b.example.com now")] * 3000 + [(2, f"text {i}") for i in range(50)]
    assert pii.training_rows(spark.createDataFrame(rows, "doc_id long, text string"), 5).count() < 60


def test_pii_training_on_many_candidates(spark):
    """Dates fill the bound on candidates many times over; both halves and labels still reach the model."""
    rng = random.Random(9)
    rows = []
    for i in range(1200):
        dates = " on ".join(f"{rng.randrange(2000, 2030)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}" for _ in range(40))
        mail = f"{rng.choice('abcde')}{i}.x@mail{i % 9}.example.com"
        rows.append((i, f"{dates} write {mail} now {dates}" if i % 6 == 0 else dates))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.training_rows(docs).count() > 2 * pii.MAX_CANDIDATES
    model = pii.train(docs)
    assert model.thresholds[0] <= 1
    found = model.added(["write to bob.y [at] mail7[dot]example[dot]com now", "2024-01-02 2011-11-12"], [[], []])
    assert [s[0] for s in found[0]] == [0] and found[1] == []
    assert pii.shares({(0, 0): 50, (0, 1): 3, (1, 0): 9, (1, 1): 1}, 30) == {(0, 0): 17, (0, 1): 3, (1, 0): 9, (1, 1): 1}


def test_pii_odd_rows(odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in pii.document_pii(odd_docs).collect()}
    assert [rows[9][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1] and rows[5]["spans"] == "" and pii.document_pii(odd_docs).count() == odd_docs.count()
    assert pii.document_pii(no_docs).count() == 0


def test_boosting_learns_and_thresholds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(int)
    p = boosting.fit(x[:1500], y[:1500]).probabilities(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95
    cut = boosting.threshold_for(p, y[1500:], 0.98)
    assert y[1500:][p >= cut].mean() >= 0.98 and boosting.threshold_for(p, np.zeros(500, int), 0.9) > 1
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).probabilities(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_toxicity_held_out(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    bad = ["scoundrel", "blockhead", "vermin", "halfwit"]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 200))]
        toxic = int(i % 4 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.document_toxicity(docs, known).collect()}
    held = [(out[i]["predicted"], toxic) for i, toxic in labels if out[i]["held_out"]]
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    assert sum(p == t for p, t in held) / len(held) > 0.95
    unlabelled = toxicity.document_toxicity(docs, known.where("toxic = 0"))
    assert unlabelled.agg(F.max("score")).first()[0] == 0.0


def test_toxicity_of_rare_words(spark):
    """Documents that hold only insults far rarer than the commonest."""
    rng = random.Random(10)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    rare = ["blockhead", "verminous", "halfwitted", "nincompoop"]
    rows, labels = [], []
    for i in range(1600):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 200))]
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(rare) if i % 20 == 0 else "scoundrel")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = [(r["doc_id"], r["predicted"]) for r in toxicity.document_toxicity(docs, known).collect() if r["held_out"]]
    only_rare = [p for i, p in out if i % 20 == 0]
    assert len(only_rare) > 10 and sum(only_rare) / len(only_rare) > 0.9
    assert sum(p == (i % 4 == 0) for i, p in out) / len(out) > 0.95


def test_toxicity_scores_by_hand(spark):
    """Every score worked out from the two dictionaries and the calibration, window by window."""
    import zstandard as z

    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    toxic, ordinary = (
        z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=z.ZstdCompressionParameters.from_level(6, source_size=88, dict_size=len(d), min_match=6, strategy=z.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False))
        for d in (model.distance.toxic, model.distance.ordinary)
    )
    found = {r["doc_id"]: r["score"] for r in queries.op5_toxicity(spark, DATA).collect()}
    for r in docs.collect():
        data, odds, at = (r["text"] or "").lower().encode(), [], 0
        while at == 0 or at < len(data) - 8:
            window = toxicity.PREAMBLE + data[at : at + 56]
            gain = len(ordinary.compress(window)) - len(toxic.compress(window))
            odds.append(float(model.odds[max(-12, min(12, gain)) + 12]))
            at += 48
        x = [sum(odds), sum(odds) / len(odds) ** 0.5, max(odds), np.log(len(odds))]
        log_odds = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.middle, model.spread, strict=True))
        assert abs(found[r["doc_id"]] - 1 / (1 + np.exp(-log_odds))) < 1e-9


def test_toxicity_held_out_in_four_languages(spark):
    """On the labelled documents that nothing was learned from."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    rows = queries.op5_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic, clean = [[r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0)]
    assert len(toxic) > 100 and sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.05


def test_toxicity_key_segments():
    rng = random.Random(12)
    words = ["".join(rng.choice("bcdfgl") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    plain = [" ".join(rng.choices(words, k=60)) for _ in range(200)]
    marked = [" ".join([*rng.choices(words, k=30), "stemwort" + rng.choice(words), *rng.choices(words, k=30)]) for _ in range(200)]
    assert b" stemwort" in toxicity.key_segments(marked, plain) and toxicity.key_segments(plain, marked) == b""
    assert toxicity.key_segments([marked[0]] * 500, plain) == b""  # copies of one document count once
    assert toxicity.key_segments([], plain) == b"" and toxicity.key_segments(plain, []) == b""


def test_toxicity_odd_rows(odd_docs, no_docs, odd_labels):
    out = toxicity.document_toxicity(odd_docs, odd_labels)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (5, 6)}) == 1 and all(r["held_out"] is not None for r in rows)
    assert toxicity.document_toxicity(no_docs, odd_labels).count() == 0


def test_quality_statistics(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    wrong = 0
    for r in queries.op7_quality_rules(spark, DATA).collect():
        text = texts[r["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and (not r["kept"] or not r["base_failed"])
        wrong += labels.get(r["doc_id"]) == 1 and not r["base_failed"] and not r["kept"]
    assert wrong <= 1


def test_quality_rules_are_learned(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice("abcdefgh") * rng.randrange(2, 9) + str(rng.randrange(10_000)) for _ in range(rng.randrange(60, 120))]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + "$" * bad for w in words)))
        labels.append((i, int(not bad)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    rules = quality.learn_rules(docs, known)
    assert rules and rules[0][0].feature == "symbols_per_word"
    judged = quality.document_verdicts(docs, known)
    assert judged.where("kept").count() == 320 and "Python" not in judged._jdf.queryExecution().toString()
    assert quality.learn_rules(docs, known.where("quality = 1")) == []


def relearned(stats, labels, parts):
    """The rule list from raw statistics: every threshold is tried on every row, nothing is binned or counted first.

    stats: doc_id to (base_failed, features); rules are lists of (feature, above, cut)."""
    names = list(quality.FEATURES)
    rows = [(1 - labels[d], parts[d], stats[d][1]) for d in stats if d in labels and not stats[d][0]]
    cuts = [sorted({float(c) for c in np.quantile([r[2][f] for r in rows], [i / quality.BINS for i in range(1, quality.BINS)])}) for f in range(len(names))] if rows else []
    holds = lambda rule, x: all((x[f] > cut) == above for f, above, cut in rule)
    count = lambda rule, some: [sum(r[0] == k and holds(rule, r[2]) for r in some) for k in (1, 0)]
    grow, prune, rules = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1], []
    while len(rules) < quality.MAX_RULES:
        rule = []
        while len(rule) < quality.MAX_CONDITIONS:
            bad, good = count(rule, grow)
            if not bad or not good:
                break
            best, choice = 0.0, None
            for f in range(len(names)):
                for cut in cuts[f]:
                    for above in (False, True):
                        p, n = count([*rule, (f, above, cut)], grow)
                        gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p else 0.0
                        if gain > best:
                            best, choice = gain, (f, above, cut)
            if choice is None:
                break
            rule.append(choice)

        def worth(some):
            bad, good = count(some, prune)
            return (bad - good) / (bad + good) if bad + good else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        bad, good = count(rule, prune)
        if not rule or bad < quality.MIN_COVERED or bad < quality.MIN_PRECISION * (bad + good):
            break
        rules.append(rule)
        grow, prune = ([r for r in some if not holds(rule, r[2])] for some in (grow, prune))
    return rules, holds


@pytest.mark.parametrize("made", [False, True])
def test_quality_verdicts_equal_brute_force(spark, made):
    """Rules and every document's verdict, on the table and on texts where two conditions have to meet."""
    if made:
        rng = random.Random(6)
        rows, known = [], []
        for i in range(700):
            long, shout = rng.random() < 0.5, rng.random() < 0.5
            words = [rng.choice("abcdefgh") * rng.randrange(2, 5) + ("LMNOP" if shout else "lmnop") + str(rng.randrange(10_000)) for _ in range(rng.randrange(150, 200) if long else rng.randrange(60, 100))]
            rows.append((i, " ".join(words) + (" $$$$" if i % 9 == 0 else "")))
            known.append((i, int(not (long and shout or i % 9 == 0))))
        docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, quality int")
    else:
        docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    stats = {r["doc_id"]: (r["base_failed"], list(r)[2:]) for r in quality.document_stats(docs).select("doc_id", "base_failed", *(F.expr(f"double({e})").alias(f) for f, e in quality.FEATURES.items())).collect()}
    parts = {r[0]: r[1] for r in docs.select("doc_id", F.expr("int(pmod(xxhash64(doc_id, 7L), 3) = 0)")).collect()}
    rules, holds = relearned(stats, {r["doc_id"]: r["quality"] for r in labels.collect()}, parts)
    assert rules and (not made or max(map(len, rules)) > 1)
    for r in quality.document_verdicts(docs, labels).select("doc_id", "kept", "rule").collect():
        failed, x = stats[r["doc_id"]]
        first = next((i for i, rule in enumerate(rules) if holds(rule, x)), None)
        assert (r["rule"], r["kept"]) == (first if first is None else first + 1, not failed and first is None), r


def test_learning_is_bounded_by_rows(spark):
    rows = [(1, "one two three " * 30)] * 2000 + [(i, f"text {i} " * 60) for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    assert quality.labelled_sample(docs, labels, limit=5).count() == 5 and quality.labelled_sample(docs, labels).count() == 11
    assert toxicity.training_texts(docs, labels, limit=2).count() <= 4


def test_quality_odd_rows(odd_docs, no_docs, odd_labels):
    out = quality.document_verdicts(odd_docs, odd_labels)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == odd_docs.count() and rows[5]["n_words"] == 0 and rows[5]["base_failed"] and rows[8]["n_words"] == 30_000
    assert quality.keep_good(odd_docs, odd_labels).columns == odd_docs.columns
    named = odd_docs.select("doc_id", "text", F.lit("x").alias("words"), F.lit("y").alias("lines"))
    assert quality.document_stats(named, ["doc_id", "words", "lines"]).where("words = 'x' and lines = 'y'").count() == odd_docs.count()
    assert quality.document_verdicts(no_docs, odd_labels).count() == 0


def test_mixing_equals_sql(same_rows):
    same_rows(queries.op2_mixing, mixing.ORACLE_SQL)


def test_raking_meets_its_targets(spark):
    cells = spark.createDataFrame([(s, l, t, 10 + 7 * i + 3 * j + k) for i, s in enumerate("ab") for j, l in enumerate("xyz") for k, t in enumerate("pq")], "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 3.0, "b": 1.0}, "lang": {"x": 1.0, "y": 1.0, "z": 2.0}, "topic": {"p": 1.0, "q": 1.0}}
    raked = mixing.rake(cells, targets, rounds=20)
    share = lambda d: {r[0]: round(r[1], 6) for r in raked.groupBy(d).agg(F.sum("weight")).collect()}
    assert share("source") == {"a": 0.75, "b": 0.25} and share("lang") == {"x": 0.25, "y": 0.25, "z": 0.5} and share("topic") == {"p": 0.5, "q": 0.5}
    given = mixing.probabilities(raked, 0.5)
    kept = given.agg(F.sum(F.col("p") * F.col("tokens")) / F.sum("tokens"), F.max("p")).first()
    assert abs(kept[0] - 0.5) < 0.01 and kept[1] <= 1


def test_mixing_odd_rows(odd_docs, no_docs):
    out = mixing.sample(odd_docs)
    assert out.count() == odd_docs.count() and {"topic", "tokens", "p", "chosen"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert mixing.keep_sample(odd_docs).columns == odd_docs.columns
    assert mixing.sample(no_docs).count() == 0 and mixing.document_mix(odd_docs).count() == odd_docs.count()


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(MODEL)


def test_pieces_round_trip(vocabulary):
    rng = random.Random(4)
    texts = ["", " ", "  a  b ", "▁", "\x00\n\t", "日本語 😀", "ÿ", "x" * 5000] + ["".join(rng.choice("abcé▁ 😀\nthxÿ") for _ in range(rng.randrange(80))) for _ in range(500)]
    encoded = pieces.Encoder(vocabulary).ids(texts)
    assert [pieces.decode_ids(np.frombuffer(b, "<i4").tolist(), vocabulary) for b in encoded] == texts


def test_segments_are_best(vocabulary):
    names = {t: i for i, t in enumerate(vocabulary.text) if t and i not in set(vocabulary.byte_ids.tolist())}
    rng = random.Random(5)
    words = [("".join(rng.choice("thein gaors") for _ in range(rng.randrange(1, 9)))).encode() for _ in range(200)]
    many = pieces.segment_many(words, vocabulary)
    assert many == [pieces.segment_one(w, vocabulary) for w in words]

    def best(word):
        scores = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if word[start:end] in names:
                    scores[end] = max(scores[end], scores[start] + vocabulary.score[names[word[start:end]]])
        return scores[-1]

    for word, ids in zip(words, many, strict=True):
        assert abs(sum(vocabulary.score[i] for i in ids) - best(word)) < 1e-9


def best_score(text, v, longest):
    """The greatest sum of scores over all segmentations of a whole text, character by character."""
    marked = " " + text
    best = [0.0] + [-np.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - longest), end):
            score = v.get(marked[start:end])
            if score is not None and best[start] + score > best[end]:
                best[end] = best[start] + score
        if marked[end - 1] not in v:
            best[end] = max(best[end], best[end - 1] + v[None])
    return best[-1]


def piece_scores(vocabulary):
    """Scores by text; None: of a character without a piece."""
    is_byte = set(vocabulary.byte_ids.tolist())
    scores = {t.decode(): float(vocabulary.score[i]) for i, t in enumerate(vocabulary.text) if t and i not in is_byte}
    return scores | {None: vocabulary.unknown}


def score_of(ids, vocabulary):
    """The summed scores of ids; bytes that spell one character count once."""
    is_byte, total, at = set(vocabulary.byte_ids.tolist()), 0.0, 0
    while at < len(ids):
        if ids[at] not in is_byte:
            total, at = total + float(vocabulary.score[ids[at]]), at + 1
        else:
            lead = vocabulary.text[ids[at]][0]
            total, at = total + vocabulary.unknown, at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
    return total


def test_pieces_query_equals_brute_force(spark, vocabulary):
    """Every document's ids spell its text and have the best score of all segmentations of the whole text."""
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    scores = piece_scores(vocabulary)
    longest = max(len(t) for t in scores if t)
    rows = queries.op6_sentencepiece(spark, DATA).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == len(r["ids"]) and r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert b"".join(vocabulary.text[i] for i in r["ids"]).decode() == " " * bool(text) + text
        if text:
            assert abs(score_of(r["ids"], vocabulary) - best_score(text, scores, longest)) < 1e-6


def test_pieces_mixed_scripts_are_best(vocabulary, monkeypatch):
    """Texts that are cut finely and ones that aren't, with little memory for words."""
    monkeypatch.setattr(pieces, "WORDS_KEPT", 40)
    monkeypatch.setattr(pieces, "WORDS_PASSING", 30)
    assert vocabulary.fine
    scores, encoder, rng = piece_scores(vocabulary), pieces.Encoder(vocabulary), random.Random(15)
    longest = max(len(t) for t in scores if t)
    for alphabet in ("the.,(); $$a-b_1é\n", "“a”.,’x— б日.a\u0301 😀"):
        for _ in range(60):
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 50))) for _ in range(4)]
            for text, packed in zip(texts, encoder.ids(texts), strict=True):
                ids = np.frombuffer(packed, "<i4").tolist()
                assert pieces.decode_ids(ids, vocabulary) == text and abs(score_of(ids, vocabulary) - best_score(text, scores, longest)) < 1e-9, ascii(text)


def test_pieces_coded_alone(spark, odd_docs, vocabulary):
    """encode() and decode() by themselves give what the one pass gives; null ids decode to the empty text."""
    docs = odd_docs.select("doc_id", "text")
    both, apart = pieces.recode(docs, MODEL), pieces.decode(pieces.encode(docs, MODEL), MODEL)
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    assert all(r["decoded"] == (r["text"] or "") for r in both.collect())
    none = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r["decoded"] for r in pieces.decode(none, MODEL).orderBy("k").collect()] == ["", ""]


def test_pieces_odd_rows(odd_docs, no_docs):
    out = pieces.document_pieces(odd_docs, MODEL)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r["round_trip"] for r in rows) and {r["n_tokens"] for r in rows if r["doc_id"] in (5, 6)} == {0}
    assert pieces.document_pieces(no_docs, MODEL).count() == 0


def test_word_encoder_equals_the_tokenizer():
    encoder = token_files.WordEncoder(TOKENS)
    rng = random.Random(6)
    texts = ["", "a\x1cb", "İSTANBUL Σ", "don't it's I'LL", "<|ENDOFTEXT|> <|endoftext|>x", "é.. f.́ ", "A.B, c.,d! x?", "　a\xa0b", "1,234.5 a1."]
    texts += ["".join(rng.choice("aAéÉ.,!'s \n\t1<|>\xa0́ß") for _ in range(60)) for _ in range(1000)]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_word_encoder_over_all_of_unicode(tmp_path):
    """Capitals before combining marks, characters that compose, case maps of several characters, odd spaces."""
    encoder = token_files.WordEncoder(TOKENS)
    assert encoder.by_word
    rng = random.Random(13)
    marks = [chr(c) for c in (*range(0x300, 0x370), 0x1DC0, 0x20D0, 0x3099, 0x0F71, 0x0F72, 0x1161, 0x11A8)]
    spaces = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    letters = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x250), *range(0x370, 0x3FF), 0x1100, 0xAC00, 0x1F600)]
    texts = [a + m for a in map(chr, range(33, 127)) for m in marks] + ["T̈", "W̊.", "J̌ x̌"]
    texts += ["".join(rng.choice(rng.choice((marks, spaces, letters))) for _ in range(rng.randrange(1, 60))) for _ in range(5000)]
    texts += ["".join(chr(c) for c in (rng.randrange(0x11000) for _ in range(30)) if not 0xD800 <= c < 0xE000) for _ in range(2000)]
    for at in range(0, len(texts), 1000):
        part = texts[at : at + 1000]
        for text, ids, whole in zip(part, encoder.ids(part), encoder.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.ids, ascii(text)
    config = json.loads(Path(TOKENS).read_text())
    config["normalizer"] = None  # case counts now, so whole texts must be encoded
    (tmp_path / "cased.json").write_text(json.dumps(config))
    cased = token_files.WordEncoder(str(tmp_path / "cased.json"))
    assert not cased.by_word and np.frombuffer(cased.ids(["The COURT  x"])[0], "<u4").tolist() == cased.tokenizer.encode("The COURT  x", add_special_tokens=False).ids


def test_word_encoder_forgets(monkeypatch):
    """Ids don't depend on what is remembered."""
    monkeypatch.setattr(token_files, "WORDS_KEPT", 50)
    monkeypatch.setattr(token_files, "WORDS_PASSING", 30)
    encoder, rng = token_files.WordEncoder(TOKENS), random.Random(14)
    for _ in range(60):
        texts = [" ".join("".join(rng.choices("abé", k=rng.randrange(1, 5))) for _ in range(20)) for _ in range(3)]
        for text, ids in zip(texts, encoder.ids(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 50 + 30 + 21
    long = "ab" * 40_000
    assert np.frombuffer(encoder.ids([long])[0], "<u4").tolist() == encoder.tokenizer.encode(long, add_special_tokens=False).ids and long not in encoder.known


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENS)
    out = {r["doc_id"]: r for r in queries.op9_token_files(spark, DATA).collect()}
    start = 0
    for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        found = out[r["doc_id"]]
        assert (found["start"], found["n_tokens"], found["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.token_file_digest(odd_docs, TOKENS).count() == odd_docs.count()
    assert token_files.token_file_digest(no_docs, TOKENS).count() == 0
    path = str(tmp_path / "tokens")
    token_files.write_tokens(odd_docs, path, TOKENS)
    one = token_files.read_tokens(spark, path).where("doc_id = 9").first()
    assert one["ids"][-1] == 1 and one["n_tokens"] == len(one["ids"])
    import pyarrow.parquet as pq

    encodings = {e for f in (tmp_path / "tokens").glob("*.parquet") for c in range(4) for e in pq.ParquetFile(f).metadata.row_group(0).column(c).encodings if pq.ParquetFile(f).metadata.num_row_groups}
    assert "DELTA_BINARY_PACKED" in encodings


def test_tiff_codecs():
    rng = random.Random(7)
    for n in (0, 1, 2, 254, 255, 256, 257, 600, 3000, 9000, 60_000):
        for alphabet in (1, 2, 30, 256):
            data = bytes(rng.randrange(alphabet) for _ in range(n))
            assert tiff.lzw_decode(tiff.lzw_encode(data)) == data == tiff.packbits_decode(tiff.packbits_encode(data))


def test_lzw_bit_by_bit():
    """The codes by the format's own rules, one after the other: a table of strings, widths raised one code early."""
    rng = random.Random(16)
    for n in (0, 1, 5, 700, 5000, 30_000):
        data = bytes(rng.randrange(40) for _ in range(n))
        table, free, width, held, bits = {bytes([i]): i for i in range(256)}, 258, 9, b"", format(256, "09b")
        for value in data:
            if held + bytes([value]) in table:
                held += bytes([value])
                continue
            bits += format(table[held], f"0{width}b")
            table[held + bytes([value])] = free
            free += 1
            held = bytes([value])
            if free == 4094:
                bits += format(256, f"0{width}b")
                table, free, width = {bytes([i]): i for i in range(256)}, 258, 9
            elif free == 1 << width:
                width += 1
        if held:
            bits += format(table[held], f"0{width}b")
            width += free + 1 == 1 << width
        bits += format(257, f"0{width}b")
        bits += "0" * (-len(bits) % 8)
        assert tiff.lzw_encode(data) == int(bits, 2).to_bytes(len(bits) // 8, "big")
    with pytest.raises(ValueError, match="beyond"):
        tiff.lzw_decode(int(format(256, "09b") + format(400, "09b") + "0" * 6, 2).to_bytes(3, "big"))


def test_every_kind_of_file_meets_every_size():
    texts = ["x" * n + str(k) for n in (0, 500, 5_000, 200_000) for k in range(60)]
    seen = {}
    for text in texts:
        payload = tiff.payload_of(text)
        data = tiff.store(payload)
        _, tags = next(tiff.directories(data))
        seen.setdefault((tags[259][0], tags[317][0]), set()).add(len(text) // 1000)
        assert b"".join(p[-2] for p in tiff.read_pages(data)) == payload
    assert set(seen) == set(tiff.KINDS) and all(len(sizes) == 3 for sizes in seen.values())


@pytest.mark.parametrize("how", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
def test_tiff_files(how, predictor):
    rng = np.random.default_rng(8)
    for tiled in (False, True):
        for order in "<>":
            grids = [rng.integers(0, 40, (rows, width)).astype(np.uint8) for rows, width in ((1, 1), (70, 130), (64, 64))]
            found = list(tiff.read_pages(tiff.write_tiff(grids, how, predictor, tiled, order)))
            assert [(p[0], p[2], p[1]) for p in found] == [(i, *g.shape) for i, g in enumerate(grids)]
            assert [p[-2] for p in found] == [g.tobytes() for g in grids]


def test_tiff_damage():
    good = tiff.store(tiff.payload_of("some text " * 100))
    assert list(tiff.read_pages(None)) == [] == list(tiff.read_pages(b""))
    assert next(tiff.read_pages(b"nonsense"))[0] == -1
    assert next(tiff.read_pages(good[:-40]))[-1]
    loop = bytearray(tiff.write_tiff([np.zeros((1, 1), np.uint8)]))
    at = int.from_bytes(loop[4:8], "little")
    loop[-4:] = at.to_bytes(4, "little")
    assert len(list(tiff.read_pages(bytes(loop)))) == 1


def test_tiff_query(spark, odd_docs, no_docs):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in queries.op4_tiff_media(spark, DATA).collect():
        payload = tiff.payload_of(texts[r["doc_id"]])
        assert (r["n_bytes"], r["payload_bytes"]) == (len(texts[r["doc_id"]].encode()), len(payload)) and len(payload) % 192 == 0
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
        assert r["feature"] == tiff.feature_of(payload)
    assert tiff.document_media(odd_docs).count() == odd_docs.count() and tiff.document_media(no_docs).count() == 0
    stored = tiff.encode(odd_docs.drop("media"), keep=["doc_id"])
    by_page = tiff.pages(stored, keep=["doc_id"])
    assert by_page.where("doc_id = 8").count() == 1 and by_page.where("error is not null").count() == 0
