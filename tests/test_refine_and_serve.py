import datetime as dt

import pytest
from pyspark.sql import functions as F

from viewlake.errors import GateError
from viewlake.functions.media import channel_from_title
from viewlake.operators import gates
from viewlake.operators.filters import by_date_overlap, by_membership
from viewlake.plans import refine, serve
from viewlake.plans.curate import visitor_engagement, with_audit

EVENT = (
    "event_key string, received_at string, visitor_key string, media_id string,"
    " media_name string, media_url string, percent_viewed double, ip string, country string"
)
ENGAGEMENT = (
    "visitor_id string, media_id string, total_views bigint, avg_pct_viewed double,"
    " max_pct_viewed double, first_date_watched date, last_date_watched date"
)
D = dt.date(2026, 6, 5)


def events(spark, *rows):
    return refine.typed_events(spark.createDataFrame(list(rows), EVENT))


def engagement(spark, *rows):
    return spark.createDataFrame([(*row, D, D) for row in rows], ENGAGEMENT)


def plain(df):
    return [tuple(row) for row in df.collect()]


def test_channels(spark):
    titles = {
        "On YouTube": "Youtube", "FACEBOOK ad": "Facebook", "youtube+facebook": None,
        "neither": None, "": None, None: None,
    }
    frame = spark.createDataFrame([(t,) for t in titles], "t string")
    assert dict(plain(frame.select("t", channel_from_title(F.col("t"))))) == titles


def test_newest_attributes_and_ties(spark):
    rows = [
        ("e1", "2026-06-05T10:00:00Z", "v1", "m1", "Old youtube", "u1", 0.1, "1", "Peru"),
        ("e1", "2026-06-05T23:30:00-02:00", "v1", "m1", "New facebook", "u2", 0.2, "2", "Chile"),
        ("e2", "2026-06-05T23:30:00-02:00", "v1", "m1", "New facebook", "u3", 0.3, "2", "Cuba"),
        ("e3", "not a time", "v2", "m1", "Zero youtube", "u9", 0.4, "3", "Fiji"),
    ]
    batch = events(spark, *rows)
    assert plain(refine.dim_media(batch)) == [("m1", "New facebook", "u3", "Facebook")]
    assert sorted(plain(refine.dim_visitors(batch))) == [("v1", "2", "Cuba"), ("v2", "3", "Fiji")]
    facts = {row[0]: row[3:] for row in plain(refine.fact_media_engagement(batch))}
    # The date is the UTC date of the newest copy.
    assert facts["e1"] == (dt.date(2026, 6, 6), 0.2)
    assert facts["e3"] == (None, 0.4)


def test_channel_gate_sees_outdated_rows(spark):
    batch = events(
        spark,
        ("e1", "2026-06-05T10:00:00Z", "v1", "m1", "Untitled", "u", 0.1, "1", "Peru"),
        ("e2", "2026-06-05T11:00:00Z", "v1", "m1", "Named youtube", "u", 0.1, "1", "Peru"),
    )
    with pytest.raises(GateError, match="m1='Untitled'"):
        refine.build_table(batch, refine.DIM_MEDIA)
    assert refine.build_table(batch, refine.FACT).count() == 2


def test_missing_columns_are_listed_sorted():
    with pytest.raises(GateError, match=r"fact lacks 2 column\(s\): \['a', 'b'\]"):
        gates.require_columns(["c"], ["b", "c", "a"], "fact")


def test_curated_counts_and_audit(spark):
    fact = spark.createDataFrame(
        [("e1", "v", "m", D, 0.2), ("e2", "v", "m", None, None), (None, "v", "m", D, 0.4)],
        "event_id string, visitor_id string, media_id string, date date, watched_percent double",
    )
    row = plain(with_audit(visitor_engagement(fact), "2026-06-05", "2026-06-06 01:00:00", "r"))[0]
    assert row[:3] == ("v", "m", 2) and abs(row[3] - 0.3) < 1e-12
    assert row[5:] == (D, D, D, dt.datetime(2026, 6, 6, 1), "r")
    audited = with_audit(visitor_engagement(fact), None, "2026-06-06 01:00:00", "r")
    assert dict(audited.dtypes)["data_through_date"] == "date"


def test_enrich(spark):
    rows = engagement(spark, ("v1", "m1", 1, 0.5, 0.5), ("v2", "m9", 2, 0.5, float("nan")))
    media = spark.createDataFrame(
        [("m1", "T", None), ("m1", "T", None)], "media_id string, title string, channel string"
    )
    visitors = spark.createDataFrame(
        [("v1", None, "Peru")], "visitor_id string, ip_address string, country string"
    )
    found = {r["visitor_id"]: r for r in serve.enrich(rows, media, visitors).collect()}
    assert len(found) == 2
    assert (found["v1"]["title"], found["v1"]["channel"]) == ("T", "Unknown")
    assert (found["v1"]["ip_address"], found["v1"]["country"]) == ("Unknown", "Peru")
    assert (found["v2"]["title"], found["v2"]["country"]) == ("Unknown", "Unknown")
    assert found["v2"]["max_pct_viewed"] is None
    alone = serve.enrich(rows).filter("visitor_id = 'v2'").collect()[0]
    assert (alone["title"], alone["channel"], alone["country"]) == ("m9", "Unknown", "Unknown")


def test_hot_join_key_without_broadcast(spark, settings):
    """A media with most rows gives the same result through a split shuffle join."""
    rows = spark.range(20000).selectExpr(
        "concat('v', id) visitor_id", "if(id % 3 > 0, 'hot', concat('m', id)) media_id",
        "1L total_views", "0.5D avg_pct_viewed", "0.5D max_pct_viewed",
        "date'2026-06-05' first_date_watched", "date'2026-06-05' last_date_watched",
    )
    media = rows.select("media_id").distinct().selectExpr(
        "media_id", "concat('T', media_id) title", "'Youtube' channel"
    )
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        settings(key, "-1")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    joined = serve.enrich(rows.repartition(8), media)
    assert joined.filter("title = concat('T', media_id)").count() == 20000
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_kpis_and_media_summary(spark):
    rows = serve.enrich(
        engagement(
            spark,
            ("v1", "m1", 3, 0.5, 0.9), ("v1", "m2", 1, None, None), ("v2", "m1", 1, 0.1, 0.75),
            ("v3", "m1", 2, 0.2, 0.7),
        )
    )
    # The missing share keeps its view in the denominator.
    assert plain(serve.kpis(rows)) == [(3, 7, pytest.approx(2.0 / 7), 2)]
    assert plain(serve.kpis(rows.filter("false"))) == [(0, 0, 0.0, 0)]
    assert plain(serve.media_summary(rows)) == [
        ("m1", "m1", "Unknown", 6, 3, pytest.approx(2.0 / 6)), ("m2", "m2", "Unknown", 1, 1, 0.0),
    ]


def test_bands(spark):
    shares = [-0.5, -0.001, 0.0, 0.25, 0.2500001, 0.5, 0.75, 1.0, 1.0001, None, float("nan")]
    rows = engagement(spark, *[(f"v{i}", "m", 1, s, s) for i, s in enumerate(shares)])
    found = dict(plain(serve.engagement_bands(serve.normalized_engagement(rows))))
    assert found == {"0–25%": 2, "25–50%": 2, "50–75%": 1, "75–100%": 1}


def test_rankings_and_domains(spark):
    rows = serve.enrich(
        engagement(
            spark, *[(f"v{i:02}", f"m{i % 3}", 1 + (i == 7), 0.5, i / 100) for i in range(20)]
        )
    )
    top = plain(serve.top_visitors(rows))
    assert len(top) == 15 and [t[0] for t in top[:3]] == ["v07", "v19", "v18"]
    countries = rows.withColumn("country", F.col("visitor_id"))
    assert [r[0] for r in plain(serve.top_countries(countries))][:2] == ["v07", "v00"]
    assert len(plain(serve.top_countries(countries))) == 10
    domains = plain(serve.filter_domains(rows))
    assert domains == [
        ("channel", "Unknown"), ("country", "Unknown"),
        ("media", "m0"), ("media", "m1"), ("media", "m2"),
    ]
    assert dict(plain(serve.media_labels(rows))) == {"m0": "m0", "m1": "m1", "m2": "m2"}
    assert plain(serve.detail(rows))[0][0] == "v07"


def test_filters(spark):
    rows = spark.createDataFrame(
        [("m1", "c", "x", dt.date(2026, 6, 1), D), ("m2", "c", "x", D, dt.date(2026, 6, 9))],
        "media_id string, channel string, country string, first_date_watched date,"
        " last_date_watched date",
    )
    assert by_membership(rows, ["m1"], ["c"], ["x", "y"]).count() == 1
    assert by_membership(rows, [], ["c"], ["x"]).count() == 0
    assert by_date_overlap(rows, D, D).count() == 2
    assert by_date_overlap(rows, dt.date(2026, 6, 6), dt.date(2026, 6, 30)).count() == 1


def test_freshness_and_watch_dates(spark):
    rows = engagement(spark, ("v", "m", 1, 0.5, 0.5))
    assert plain(serve.pipeline_freshness(rows)) == [(None, None, None)]
    audited = with_audit(rows, D, "2026-06-06 01:00:00", "r1")
    assert plain(serve.pipeline_freshness(audited)) == [(D, dt.datetime(2026, 6, 6, 1), "r1")]
    gates.require_watch_dates(rows)
    with pytest.raises(GateError):
        gates.require_watch_dates(rows.withColumn("last_date_watched", F.lit("someday")))
