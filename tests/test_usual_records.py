"""Usual records are judged by a pattern; it may only say what parsing would say."""

import json

from pyspark.sql import functions as F
from samples import event

from viewlake.functions import contract as C
from viewlake.functions import rules

FULL = event() | {
    "embed_url": None, "org": "o", "lat": 52.5, "lon": -13, "conversion_type": 7,
    "thumbnail": {"url": "u", "width": 1, "type": None}, "conversion_data": None,
    "user_agent_details": {"browser": "b", "mobile": False},
}


def lines():
    full = json.dumps(FULL)
    found = [full, json.dumps(FULL, separators=(",", ":")), json.dumps(dict(reversed(FULL.items()))), full + "\r", full + " x", full[:-1] + ",}"]
    spelled = ["-0", "0", "1", "1.0", "1.5", "-0.1", "01", "1.", ".5", "1e0", "1E-1", "1.00000000000000000001", "0." + "9" * 30, "1e400", "NaN", "true", '"0.5"', "null", "9" * 25, "1E-99", "+1"]
    spelled += ['"a\\"b"', '"a\tb"', '"a\x00b"', '"é \U0001f600"', "{}", "[]", '"2024-02-29T10:00:00Z"', '"2024-02-30T10:00:00Z"', '"2023-04-31T10:00:00Z"', '"2024-12-31T23:59:59.123456Z"', '"0000-01-01T00:00:00Z"', '"2024-01-01"', '"2024-01-01T24:00:00Z"', '"x~end-of-line~"', '"y","event_key":"z"', '{"url":"u","media_id":"m"}', '{"width":1.0}', '{"mobile":true}', '{"url":"u","new":1}']
    for name in [*FULL, "new_field", "Event_key"]:
        rest = {k: v for k, v in FULL.items() if k != name}
        found.append(json.dumps(rest))
        for value in spelled:
            found.append(json.dumps(rest)[:-1] + f',"{name}":{value}}}')  # in place of the member
            found.append(json.dumps(FULL)[:-1] + f',"{name}":{value}}}')  # behind it
            found.append(f'{{"{name}":{value},' + json.dumps(FULL)[1:])  # before it
    return found


def verdicts(frame):
    rows = rules.check_lines(frame).select("n", "is_valid", "issues", F.sort_array("unknown_fields")).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_usual_records_are_judged_as_parsed_ones(spark, monkeypatch):
    texts = [(i, line.encode()) for i, line in enumerate(lines())]
    texts += [(len(texts), b"\xff".join(json.dumps(FULL).encode().split(b"o", 1))), (len(texts) + 1, None)]
    frame = spark.createDataFrame(texts, "n long, raw binary").selectExpr("n", "cast(raw as string) as value")
    usual = {r[0] for r in frame.filter(rules.usual_share("value") + " <> ''").collect()}
    found = verdicts(frame)
    monkeypatch.setattr(rules, "usual_share", lambda line: "''")
    assert found == verdicts(frame)
    assert {0, 1, 2, 3} < usual and 100 < len(usual) < len(texts) / 2
    shares = {tuple(i["code"] for i in found[n][1]) for n in usual}
    assert shares == {(), (C.OUT_OF_RANGE,)}


def test_most_lines_of_the_tables_are_not_parsed(spark):
    from viewlake.plans.runs import event_lines
    from viewlake.suite import binding as B

    plain = event_lines(B.plain_events(spark, "/root/testdata/sf0.001"))
    assert plain.filter(rules.usual_share("value") + " = ''").isEmpty()
    faulty = B.faulty_lines(spark, "/root/testdata/sf0.001")
    shares = faulty.selectExpr(f"avg(int({rules.usual_share('value')} <> ''))").first()[0]
    assert 0.5 < shares < 1


def test_raw_lines_lose_their_line_breaks_without_a_pattern(spark):
    from viewlake.plans.validate import addressed_and_checked, routed_lines

    texts = [json.dumps(FULL) + end for end in ("", "\r", " \r\r", "\r ")]
    frame = spark.createDataFrame([(t, "u", 0, i) for i, t in enumerate(texts)], "value string, source_uri string, block_start long, block_row long")
    routed = routed_lines(addressed_and_checked(frame))
    assert sorted(map(tuple, routed.collect())) == sorted(("raw", t.rstrip("\r\n")) for t in texts)
    assert "rtrim(" in (plan := routed._jdf.queryExecution().analyzed().toString().lower()) or "trim(trailing" in plan
