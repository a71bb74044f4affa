"""Payloads that give no bars, and why."""

import json

import pytest

from tapeline import wording
from tapeline.sources import documents as d

DAY = 86_400


def body(times=(1, 2), **series):
    quote = {name: [5.0] * len(times) for name in d.QUOTE_FIELDS} | series
    result = {"timestamp": [t * DAY for t in times], "indicators": {"quote": [quote]}}
    return json.dumps({"chart": {"result": [result]}})


CASES = {
    "good": (200, body(), None),
    "late": (429, body(), "unanswered"),
    "unknown": (None, body(), "unanswered"),
    "nothing": (200, None, "unreadable"),
    "cut": (200, body()[:-2], "unreadable"),
    "twice": (200, body() * 2, "unreadable"),
    "page": (200, "<html>", "unreadable"),
    "empty": (200, '{"chart": {"result": []}}', "no_result"),
    "error": (200, '{"chart": {"result": null, "error": {"code": "x"}}}', "no_result"),
    "no times": (200, body(()), "no_bars"),
    "closes": (200, body(close=[1.0]), "short"),
    "volumes": (200, body(volume=[1]), "short"),
    "no volumes": (200, body(volume=[]), "short"),
    "null closes": (200, body(close=[None, None]), "no_close"),
    "word": (200, body(open=[1.0, "none"]), "no_number"),
    "word before a gap": (200, body(open=["none", 1.0], close=[None, 1.0]), None),
    "quoted": (200, body(open=["1.5", 1.0]), None),
    "never": (200, body((1, 10**12)), "not_storable"),
    "volume": (200, body(volume=[1, 1e300]), "not_storable"),
}


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame([(k, s, b) for k, (s, b, _) in CASES.items()], "ticker string, status int, body string")


def test_reasons(spark, payloads):
    found = {r.ticker: r.reason for r in d.parsed_payloads(payloads).collect()}
    assert found == {k: reason for k, (_, _, reason) in CASES.items()}


def test_every_payload_gives_bars_or_a_reason(spark, payloads):
    parsed = d.parsed_payloads(payloads)
    rejected = {r.ticker: r.message for r in d.rejected_payloads(parsed).collect()}
    decoded = {r.ticker for r in d.decode_payloads(payloads).collect()}
    assert decoded.isdisjoint(rejected) and decoded | set(rejected) == set(CASES)
    assert set(rejected.values()) <= set(wording.REJECTIONS.values())


def test_body_and_values_are_parsed_once(spark, payloads):
    for df in (d.decode_payloads(payloads), d.rejected_payloads(d.parsed_payloads(payloads))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
        assert plan.count("trim(") == 1 + len(d.QUOTE_FIELDS)
