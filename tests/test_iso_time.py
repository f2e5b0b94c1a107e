"""Times against the standard library's reader of ISO text."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from viewlake.functions.iso_time import iso_timestamp

UTC = dt.timezone.utc
DATES = ["2026-06-05", "20260605", "2026-W23-5", "2026W235", "2026-W23", "2026W23", "2026-W53-1", "2020-W53-7", "2021-W53-1",
         "2026-W00-1", "0001-01-01", "0000-01-01", "9999-12-31", "9999-W52-7", "2026-02-29", "2024-02-29", "2026-13-01", "2026-0605",
         "202606-05", "2026-156", "2026-W23-8", "2026-W23-0", "2026W2351", "0001-W01-1"]
SEPARATORS = ["T", " ", "X", "é", "-", "|", "\n", "TT"]
TIMES = ["12", "12:30", "1230", "12:30:15", "123015", "12:3015", "12:30:15.5", "12:30:15,123456789", "123015.000001", "24:00",
         "23:59:60", "12:30:", "1", "", "12:30:15."]
OFFSETS = ["", "Z", "+00:00", "-05:30", "+0530", "+05", "-23:59:59", "+01:02:03.5", "+24:00", "+05:3", "z", "+01:02:03,25"]


def plain(text):
    """The moment, a naive one in UTC; None where the text is no ISO time."""
    try:
        value = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value


def loaded(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    rows = frame.selectExpr("i", f"unix_micros({iso_timestamp('t')}) as micros").orderBy("i").collect()
    return [r["micros"] for r in rows]


def micros(moment):
    return None if moment is None else (moment - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)


def test_all_parts(spark):
    texts = DATES + [d + s + t + o for d in DATES for s in SEPARATORS for t in TIMES[:9] for o in OFFSETS[:7]]
    texts += [f"2026-06-05T{t}" for t in TIMES] + [f"2026-06-05T12:30{o}" for o in OFFSETS] + ["2026-06-05\n", "2026-06", "", "T", "2026", " 2026-06-05", "2026-06-05 ", "yesterday"]
    found = loaded(spark, texts)
    wrong = [(t, f, micros(plain(t))) for t, f in zip(texts, found, strict=True) if f != micros(plain(t))]
    assert not wrong, (len(wrong), len(texts), wrong[:20])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text("0123456789-:WTZ+., ", max_size=30) | st.datetimes(min_value=dt.datetime(1900, 1, 1)).map(str), min_size=1, max_size=60))
def test_any_text(spark, texts):
    assert loaded(spark, texts) == [micros(plain(t)) for t in texts]
