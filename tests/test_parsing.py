"""Declared parsers and the ingest plan on text pages."""

import datetime as dt

import pytest

from docketeer.functions import classify
from docketeer.operators import parsing
from docketeer.plans import ingest

TUOLUMNE = ["Tentative rulings for Monday, June 1, 2020\nDepartment 5\n", "CV68039 01/02/2020 1 Smith v. Jones\nMotion to Compel\nThe motion is granted.\n", "CVL66996 03/04/2020 2 Doe v. Roe\nDemurrer\nThe demurrer is denied.\nContinued to July 6, 2020.\n"]


def docs(spark, pages, sha="a" * 64, county="tuolumne"):
    return spark.createDataFrame([(county, sha, "pdf", f"https://court/{sha[:4]}.pdf", pages)], "county string, source_sha256 string, extension string, source_url string, pages array<string>")


def test_one_page_per_case(spark):
    found = parsing.extract(docs(spark, TUOLUMNE), parsing.SPECS["tuolumne"]).orderBy("ruling_index").collect()
    assert [r["case_number"] for r in found] == ["CV68039", "CVL66996"]
    assert [r["case_title"] for r in found] == ["Smith v. Jones", "Doe v. Roe"]
    assert [r["outcome"] for r in found] == ["granted", "denied"]
    assert [r["ruling_index"] for r in found] == [1, 2] and [r["page_start"] for r in found] == [2, 3]
    assert found[0]["hearing_date"] == dt.date(2020, 6, 1) and found[1]["continued_to"] == dt.date(2020, 7, 6)
    assert len({r["ruling_id"] for r in found}) == 2


@pytest.mark.parametrize("pages", [[], [""], ["no date here"], ["June 1, 2020 but no case"]])
def test_nothing_found(spark, pages):
    assert parsing.extract(docs(spark, pages), parsing.SPECS["tuolumne"]).count() == 0


def test_whole_body_is_the_outcome_text(spark):
    body = "The motion is discussed here. " * 100 + "The motion is denied."
    found = parsing.extract(docs(spark, [TUOLUMNE[0], f"CV68039 01/02/2020 1 Smith v. Jones\nMotion to Compel\n{body}\n"]), parsing.SPECS["tuolumne"]).collect()
    assert len(found) == 1 and found[0]["outcome_text"] == found[0]["body_text"] == body


@pytest.mark.parametrize("county, case", [("stanislaus", "CV-20-001234"), ("sonoma", "SCV-123456"), ("amador", None), ("butte", "20CV01234")])
def test_late_dates(spark, county, case):
    """A date behind the first 4,000 characters counts, but where the reference reads a stretch alone."""
    notice = "How to ask for oral argument. \n" * 160
    ruling = f"{case} Smith v. Jones\nMotion\nGranted." if case else "Tentative ruling\n20CV01234 Smith v. Jones\nMotion\nGranted."
    found = parsing.extract(docs(spark, [f"{notice}June 1, 2020\n{ruling}"], county=county), parsing.SPECS[county]).collect()
    assert [r["hearing_date"] for r in found] == ([] if county == "butte" else [dt.date(2020, 6, 1)])


def test_early_dates_come_first(spark):
    """Where the start of the text has a date, later ones of another form don't replace it."""
    page = "June 1, 2020\nTentative ruling\n20CV01234 Smith v. Jones\nMotion\n" + "Granted. " * 600 + "\nContinued to Monday, July 6, 2020."
    found = parsing.extract(docs(spark, [page], county="amador"), parsing.SPECS["amador"]).collect()
    assert [r["hearing_date"] for r in found] == [dt.date(2020, 6, 1)]


def test_every_county_has_a_spec_that_runs(spark):
    assert set(parsing.SPECS) == set(classify.COUNTY_RULES) | set(classify.SHARED_COUNTIES)
    sample = {
        "ventura": "2020CUOE1234: Smith v. Jones\n6/1/2020 in Department 20\nMotion\nGranted.",
        "san_mateo": "June 1, 2020\n20-CIV-01234 Smith v. Jones\nMotion\nGranted.",
        "placer": "June 1, 2020\n1. S-CV-0041234 Smith v. Jones\nMotion\nGranted.",
        "el_dorado": "June 1, 2020\nTENTATIVE RULING # 1:\nPC20201234 Smith v. Jones\nMotion GRANTED.",
        "stanislaus": "June 1, 2020\nCV-20-001234 - Smith v. Jones\nMotion\nGranted.",
        "monterey": "June 1, 2020\n20CV001234 Smith v. Jones\nMotion\nGranted.",
    }
    for county, text in sample.items():
        found = parsing.extract(docs(spark, [text], county=county), parsing.SPECS[county]).collect()
        assert len(found) == 1 and found[0]["outcome"] == "granted", (county, found)


def test_ingest_is_idempotent_and_drops_recaptures(spark):
    log = spark.createDataFrame([("a" * 64, "https://court/a.pdf", None, None, 0)], "source_sha256 string, source_url string, dept_hint string, division_hint string, line_no long")
    both = docs(spark, TUOLUMNE).union(docs(spark, TUOLUMNE, "b" * 64)).drop("source_url")
    first = ingest.new_rulings(both, log, None, "tuolumne")
    assert first.count() == 2 and {r["source_url"] for r in first.collect()} == {"https://court/a.pdf"}
    again = ingest.new_rulings(docs(spark, TUOLUMNE, "c" * 64).drop("source_url"), log, first, "tuolumne")
    assert again.count() == 0
    assert ingest.merged_rulings(first, again).count() == 2
