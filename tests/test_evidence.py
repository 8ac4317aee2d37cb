"""Canonical JSON, its digests and texts, and boards' structured evidence, against values worked out by hand."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.canonical import canonical_json, hashed_content, json_sha256, json_text, quoted
from millrace.operators.provider_evidence import evidence
from millrace.sources import boards


def values(spark, function, texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, v string")
    return [r[0] for r in rows.orderBy("k").select(function(F.col("v"))).collect()]


def test_canonical_form(spark):
    given = ['{"b": 1, "a": [null, true, 1.0, 1, 1e3]}', '{"é": "ü 🙂", "e": {}}', '"x"', "nonsense", None, '{"a": 1, "a": 2}', "12345678901234567890123", "{ }", ""]
    want = ['{"a":[null,true,1.0,1,1000.0],"b":1}', '{"e":{},"\\u00e9":"\\u00fc \\ud83d\\ude42"}', '"x"', None, None, '{"a":2}', "12345678901234567890123", "{}", None]
    assert values(spark, canonical_json, given) == want
    assert values(spark, json_sha256, given) == [hashlib.sha256(w.encode()).hexdigest() if w is not None else None for w in want]


def test_plain_text(spark):
    given = ['{"b": " x ", "a": [1, true, null, ["y", {}], ""], "c": null}', '"  t "', "1.5", "null", "[]"]
    assert values(spark, json_text, given) == ["b x a 1 true y c", "t", "1.5", "", ""]


def test_hashed_content(spark):
    rows = spark.createDataFrame([('say "é"\n', None, '{"z": 1, "a": null}')], "t string, n string, j string")
    got = rows.select(hashed_content({"title": quoted(F.col("t")), "none": quoted(F.col("n")), "evidence": F.col("j")})).first()[0]
    text = '{"evidence":{"a":null,"z":1},"none":null,"title":"say \\"\\u00e9\\"\\n"}'
    assert got == hashlib.sha256(text.encode()).hexdigest()


BOARD_A = {
    "id": 7, "title": " Engineer ", "absolute_url": "https://x/1", "content": "<p>Work&nbsp;here</p>", "location": {"name": " Berlin "}, "departments": [{"name": "R&D"}], "reqId": " R-9 ",
    "offices": [{"name": "B", "location": None}, {"name": "A", "location": "x", "id": 3}, {"name": "B"}, "no"],
    "metadata": [
        {"id": 1, "name": "Eligible Countries", "value_type": "multi", "value": ["Peru, chile", {"k": "Chile | Peru"}, 5]},
        {"id": 2, "name": "Visa", "value": None}, {"name": "Level", "value": "Senior"}, {"name": "Level", "value": "Senior"}, {"name": " "}, 4,
    ],
    "language": "en",
}


def test_board_a(spark):
    got = json.loads(values(spark, evidence("board_a", "p"), [json.dumps(BOARD_A)])[0])
    assert got == {
        "schema_version": 1, "provider": "p", "requisition_id": "R-9", "workplace": {}, "primary_location": {"label": "Berlin"}, "secondary_locations": [],
        "offices": [{"location": "x", "name": "A"}, {"name": "B"}], "countries": ["chile", "Peru"],
        "provider_metadata": [
            {"name": "Eligible Countries", "value": ["Peru, chile", {"k": "Chile | Peru"}, 5], "value_type": "multi"}, {"name": "Level", "value": "Senior"}, {"name": "Visa", "value": None},
        ],
        "eligibility_signals": [
            {"kind": "provider_metadata", "name": "Eligible Countries", "value": ["Peru, chile", {"k": "Chile | Peru"}, 5], "value_type": "multi"}, {"kind": "provider_metadata", "name": "Visa", "value": None},
        ],
        "application": {"is_listed": True, "language": "en", "posting_url": "https://x/1"},
    }
    row = boards.board_a(spark.createDataFrame([("s", json.dumps({"jobs": [BOARD_A]}))], "source_id string, payload string"), "p").first()
    said = {"title": "Engineer", "description_text": "Work here", "location": "Berlin", "department": "R&D", "employment_type": None, "posting_url": "https://x/1", "apply_url": None, "structured_evidence": got}
    assert row.content_hash == hashlib.sha256(json.dumps(said, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert json.loads(row.structured_evidence) == got


def test_board_b(spark):
    payload = {
        "location": "Paris", "address": {"postalAddress": {"addressLocality": "Paris", "addressCountry": "France"}}, "isRemote": True, "workplaceType": "On Site", "isListed": True, "jobUrl": "j", "applyUrl": " ",
        "secondaryLocations": [{"location": "Rome", "address": {"addressCountry": "france"}}, {"location": None}, {"location": "Rome", "address": {"addressCountry": "france"}}],
    }
    got = json.loads(values(spark, evidence("board_b", "p"), [json.dumps(payload)])[0])
    assert got["workplace"] == {"type": "on_site", "is_remote": True} and got["countries"] == ["France"] and got["application"] == {"is_listed": True, "posting_url": "j"}
    assert got["primary_location"] == {"label": "Paris", "locality": "Paris", "country": "France"} and got["secondary_locations"] == [{"label": "Rome", "country": "france"}]
    assert got["requisition_id"] is None and got["offices"] == []


@pytest.mark.parametrize("shape", ["board_a", "board_b"])
def test_odd_payloads(spark, shape):
    got = values(spark, evidence(shape, "p"), ["{}", "[]", None, "x", '{"metadata": {}, "offices": "o", "secondaryLocations": 3, "address": [], "location": 5, "isRemote": "yes"}'])
    assert [g is None for g in got] == [False, True, True, True, False] and json.loads(got[4])["primary_location"] == {"label": "5"}
