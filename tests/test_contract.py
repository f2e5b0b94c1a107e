"""Contract rules, one job for all cases."""

import json

from samples import event, line

from viewlake.functions import contract as C
from viewlake.functions.rules import check_lines

TIMES = {
    "2026-06-05T12:00:00Z": True,
    "2026-06-05": True,
    "2026-06-05 12:00": True,
    "2026-06-05T12:00:00.123456+02:00": True,
    "2026-06-05T12": True,
    "2026-06-05T24:00:00": False,
    "2026-06-05T12:60:00Z": False,
    "2026-02-30T12:00:00Z": False,
    "2024-02-29T00:00:00Z": True,
    "2026": False,
    "2026-06": False,
    "12:00": False,
    "0000-01-01": False,
    "2026-06-05T": False,
    "": False,
}

# name -> (line, issues, unknown fields)
CASES = {
    "valid": (line(), [], []),
    "empty strings": (line(event_key="", ip=""), [], []),
    "missing": (line(event_key=...), ["missing_required_field:event_key"], []),
    "two missing": (
        line(event_key=..., country=...),
        ["missing_required_field:event_key", "missing_required_field:country"],
        [],
    ),
    "null": (line(country=None), ["null_required_field:country"], []),
    "wrong type": (line(lat="south"), ["invalid_type:lat"], []),
    "number as text": (line(event_key=5), ["invalid_type:event_key"], []),
    "two kinds": (
        line(received_at="soon", percent_viewed=1.5),
        ["invalid_type:received_at", "out_of_range:percent_viewed"],
        [],
    ),
    "boolean is no number": (line(percent_viewed=True), ["invalid_type:percent_viewed"], []),
    "integer share": (line(percent_viewed=1), [], []),
    "bounds": (line(percent_viewed=1.0), [], []),
    "below": (line(percent_viewed=-0.001), ["out_of_range:percent_viewed"], []),
    "nan share": (line(percent_viewed=float("nan")), ["out_of_range:percent_viewed"], []),
    "nan elsewhere": (line(lat=float("nan"), lon=float("-inf")), [], []),
    "nan in a title": (line(media_name="a, NaN, b"), [], []),
    "drift": (
        line(new_field=1, thumbnail={"url": "u", "new_size": 2}),
        [],
        ["new_field", "thumbnail.new_size"],
    ),
    "drift with error": (
        line(new_field=1, country=None),
        ["null_required_field:country"],
        ["new_field"],
    ),
    "optional nulls": (line(lat=None, thumbnail=None, conversion_type=None), [], []),
    "union integer": (line(conversion_type=4), [], []),
    "union string": (line(conversion_type="form"), [], []),
    "union other": (line(conversion_type=1.5), ["invalid_type:conversion_type"], []),
    "union boolean": (line(conversion_type=False), ["invalid_type:conversion_type"], []),
    "object expected": (line(thumbnail="u"), ["invalid_type:thumbnail"], []),
    "array is no object": (line(conversion_data=[1]), ["invalid_type:conversion_data"], []),
    "nested type": (line(thumbnail={"width": "5"}), ["invalid_type:thumbnail.width"], []),
    "nested null": (line(thumbnail={"width": None}), [], []),
    "decimal is no integer": (
        line(thumbnail={"width": 1.0}),
        ["invalid_type:thumbnail.width"],
        [],
    ),
    "large integer": (line(thumbnail={"width": 2**70}), [], []),
    "integer of any length": (line(conversion_type=int("7" * 45), thumbnail={"width": -(10**60)}), [], []),
    "large number that is no integer": (
        line(conversion_type=1e60),
        ["invalid_type:conversion_type"],
        [],
    ),
    "nested boolean": (
        line(user_agent_details={"mobile": "no"}),
        ["invalid_type:user_agent_details.mobile"],
        [],
    ),
    "empty object": ("{}", [f"missing_required_field:{f.name}" for f in C.REQUIRED], []),
    "array": (f"[{line()}]", ["invalid_record_type:$"], []),
    "text": ('"text"', ["invalid_record_type:$"], []),
    "number": ("17", ["invalid_record_type:$"], []),
    "null record": ("null", ["invalid_record_type:$"], []),
    "bare nan": ("NaN", ["invalid_record_type:$"], []),
    "empty": ("", ["malformed_json:$"], []),
    "blank": ("   ", ["malformed_json:$"], []),
    "cut off": (line()[:-1], ["malformed_json:$"], []),
    "trailing text": (line() + " x", ["malformed_json:$"], []),
    "two records": (line() + line(), ["malformed_json:$"], []),
    "listed records": (line() + "," + line(), ["malformed_json:$"], []),
    "closing bracket": ("1],[2", ["malformed_json:$"], []),
    "closing brace": ('1},{"r":2', ["malformed_json:$"], []),
    "end mark": (line(media_name='x "~end-of-line~" Youtube'), [], []),
    "forged end mark": ('1,"~end-of-line~"],[', ["malformed_json:$"], []),
    "forged end mark and brace": ('1,"~end-of-line~"],[{"r":1},{', ["malformed_json:$"], []),
    "any separator": (line(received_at="2026-06-05X12:30:00"), [], []),
    "comma fraction": (line(received_at="2026-06-05T12:30:00,5"), [], []),
    "week date": (line(received_at="2026-W23-5T12:30Z"), [], []),
    "spaces and CR": ("  " + line() + " \r", [], []),
    "duplicate key": ('{"country":null,' + line()[1:], [], []),
}
CASES |= {
    f"time {text}": (line(received_at=text), [] if ok else ["invalid_type:received_at"], [])
    for text, ok in TIMES.items()
}


def test_all_cases(spark):
    rows = [(name, text) for name, (text, _, _) in CASES.items()]
    checked = check_lines(spark.createDataFrame(rows, "name string, value string"))
    found = {
        row["name"]: (
            row["is_valid"],
            [f"{i['code']}:{i['field']}" for i in row["issues"]],
            sorted(row["unknown_fields"]),
        )
        for row in checked.collect()
    }
    expected = {name: (not issues, issues, sorted(u)) for name, (_, issues, u) in CASES.items()}
    assert found == expected


MIB = 1 << 20


def long_lines():
    """Lines beyond the parser's own limits for a text, and what is wrong with them."""
    return {
        "one long text": (line(org="x" * (20 * MIB)), [], []),
        "long unknown text": (line(extra="y" * (21 * MIB), percent_viewed=2), ["out_of_range:percent_viewed"], ["extra"]),
        "forty MiB": (line(org="x" * (39 * MIB), thumbnail={"url": "u", "size": 1}, lat=float("nan")), [], ["thumbnail.size"]),
        "many members": (line(**{f"k{i}": "z" * 1000 for i in range(21_000)}), [], [f"k{i}" for i in range(21_000)]),
        "long and cut off": (line(org="x" * (20 * MIB))[:-1], ["malformed_json:$"], []),
        "long and followed": (line(org="x" * (20 * MIB)) + " x", ["malformed_json:$"], []),
        "long list": (f"[{line(org='x' * (20 * MIB))}]", ["invalid_record_type:$"], []),
        "long text alone": ('"' + "x" * (20 * MIB) + '"', ["invalid_record_type:$"], []),
        "number of many digits": (line(lat=int("1" * 1500)), [], []),
    }


def test_no_length_makes_a_line_malformed(spark, folder):
    for name, (text, issues, unknown) in long_lines().items():
        spark.createDataFrame([(name, text)], "name string, value string").write.mode("append").parquet(folder)
    found = {
        row["name"]: ([f"{i['code']}:{i['field']}" for i in row["issues"]], sorted(row["unknown_fields"]), row["is_valid"])
        for row in check_lines(spark.read.parquet(folder)).drop("value").collect()
    }
    assert found == {n: (i, sorted(u), not i) for n, (_, i, u) in long_lines().items()}


def test_messages(spark):
    frame = spark.createDataFrame([(line(conversion_type=[], thumbnail=1, ip=None),)], "value string")
    issues = check_lines(frame).collect()[0]["issues"]
    assert [i["message"] for i in issues] == [
        "Required field cannot be null.",
        "Expected object.",
        "Expected integer or string.",
    ]


def test_invalid_utf8_is_malformed(spark):
    frame = spark.createDataFrame([(bytearray(line().encode() + b"\xff"),)], "raw binary")
    frame = frame.selectExpr("cast(raw as string) as value")
    assert check_lines(frame).collect()[0]["issues"][0]["code"] == "malformed_json"


def test_filters_do_not_reach_the_parser(spark):
    """A filter on the result must not copy the parsing into the plan again and again."""
    frame = spark.createDataFrame([(line(),)], "value string")
    checked = check_lines(frame).filter("is_valid and size(issues) = 0")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson") <= 4


def test_raw_schema_reads_every_declared_field(spark):
    schema = C.raw_schema()
    assert schema.fieldNames()[:9] == [f.name for f in C.REQUIRED]
    text = json.dumps(event(thumbnail={"width": 3}, conversion_type="form", lat=1))
    row = spark.read.schema(schema).json(spark.sparkContext.parallelize([text])).collect()[0]
    assert (row["thumbnail"]["width"], row["lat"], row["percent_viewed"]) == (3, 1.0, 0.5)
