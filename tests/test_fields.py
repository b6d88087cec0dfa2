"""Spans, labelled values and headers against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from docketeer.functions import fields, spans


def cut(text, stretches):
    """What is left of the text, where its last stretch ends, and each place's new one."""
    if not stretches:
        return text, len(text.rstrip()), dict(enumerate(range(len(text))))
    gone = {i for a, b in stretches for i in range(a, b)}
    runs = []
    for i in (i for i in range(len(text)) if i not in gone):
        if runs and runs[-1][-1] == i - 1:
            runs[-1].append(i)
        else:
            runs.append([i])
    out, places, end = [], {}, 0
    for run in runs:
        piece = "".join(text[i] for i in run)
        if piece.strip():
            body = piece.strip("\n")
            at = sum(len(x) + 1 for x in out)
            lead = len(piece) - len(piece.lstrip("\n"))
            places |= {run[0] + lead + k: at + k for k in range(len(body))}
            out.append(body)
            end = len(text.rstrip()) if run[-1] == len(text) - 1 else run[-1] + 1
    return "\n".join(out), end, places


def test_without_spans_equals_brute_force(spark):
    rng = random.Random(3)
    cases = [("abc\n\n", []), ("", []), ("", [(0, 0)]), ("a\nb", [(0, 3)]), ("abc", [(1, 2), (0, 3)]), ("\n\nab\n", [(3, 9)]), ("  \nab", [(3, 4)])]
    for _ in range(200):
        text = "".join(rng.choice("ab \n\n") for _ in range(rng.randrange(40)))
        cases.append((text, [(a := rng.randrange(len(text) + 1), min(len(text), a + rng.randrange(1, 9))) for _ in range(rng.randrange(4))]))
    cases = [(t, c) for t, c in cases if all(a < b for a, b in c) or not t]
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(cases)], "id int, text string, spans array<struct<start:int,end:int>>")
    out = df.select("id", "text", spans.without_spans(F.col("text"), F.col("spans")).alias("c"))
    out = out.withColumn("moved", F.transform(F.sequence(F.lit(0), F.length("text")), lambda i: spans.place_after(F.col("c.pieces"), i)))
    for r in out.collect():
        text, stretches = cases[r["id"]]
        left, end, places = cut(text, stretches)
        assert (r["c"]["text"], r["c"]["kept_end"]) == (left, end), (text, stretches)
        assert r["moved"][: len(text)] == [places.get(i) for i in range(len(text))], (text, stretches)
    null = spark.createDataFrame([(None, None)], "text string, spans array<struct<start:int,end:int>>").select(spans.without_spans(F.col("text"), F.col("spans")).alias("c")).first()["c"]
    assert (null["text"], null["kept_end"], null["pieces"]) == ("", 0, [])


def test_many_spans(spark):
    """Over a chunk of the running values."""
    text = "x." * 2000
    df = spark.createDataFrame([(text, [(2 * i + 1, 2 * i + 2) for i in range(2000)])], "text string, spans array<struct<start:int,end:int>>")
    c = df.select(spans.without_spans(F.col("text"), F.col("spans")).alias("c")).first()["c"]
    assert c["text"] == "\n".join("x" * 2000) and c["kept_end"] == 3999


def test_labelled_values(spark):
    labels = ["Case Number", "Judges", "Nature"]
    rows = [(["t", "Case Number", "24CV1", "Nature", "Motion", "to compel", "Judges", "Nature", "again"],), (["Judges"],), ([],), (None,), (["Judges", "Judges", "x"],)]
    found = [r[0] for r in spark.createDataFrame(rows, "lines array<string>").select(fields.labelled_values(F.col("lines"), labels)).collect()]
    assert found[0] == {"Case Number": "24CV1", "Judges": "", "Nature": "Motion\nto compel"}
    assert found[1] == found[2] == found[3] == dict.fromkeys(labels, "") == found[4]


@pytest.mark.parametrize("given, expected", [(" Twelve. ", "12"), ("twenty-five", "25"), ("CX103", "CX103"), ("  a  b ", "a b"), ("", None), (None, None), ("twenty-six", "twenty-six")])
def test_department(value, given, expected):
    assert value(fields.department, given) == expected


def test_department_words_end(value):
    assert value(lambda c: fields.department(c, 15), "Sixteen") == "Sixteen" and value(lambda c: fields.department(c, 15), "Fifteen") == "15"


@pytest.mark.parametrize("county, given, expected", [("amador", " 23 CV  1234 ", "23-CV-1234"), ("orange", "30 – 2023 - 0123--45-", "30-2023-0123-45"), ("san_bernardino", " civ sb 123 ", "CIVSB123"), ("other", " x ", "x")])
def test_case_number(value, county, given, expected):
    assert value(lambda c: fields.case_number(c, county), given) == expected


def test_header_division(value):
    assert value(lambda c: fields.header_division(c, "el_dorado"), "law  and\nmotion civil") == "Law and Motion"
    assert value(lambda c: fields.header_division(c, "orange"), "Law and Motion") == "Civil" and value(lambda c: fields.header_division(c, "orange", F.lit("h")), "x") == "h"
    assert value(fields.http_status, "ERROR x: 404 Client Error: Not Found") == 404 and value(fields.http_status, "timed out") is None
