"""The driver tables seen as viewing events."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.functions.json_text import member
from viewlake.plans.curate import visitor_engagement
from viewlake.plans.refine import dim_media, dim_visitors, fact_media_engagement
from viewlake.plans.serve import enrich

LAST_DAY = dt.date(2024, 1, 31)  # parameter: the day through which a dashboard's data reaches

# A first load up to and including one day, and a later correction from another day on.
LOADED_THROUGH = dt.date(2024, 1, 20)
CORRECTED_FROM = dt.date(2024, 1, 11)


# Declared, so that opening a table starts no job that reads footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "part": "p_partkey bigint, p_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Scope:
    """What there is to extract: the media of the events, from the first to the last day."""

    media_ids: list[str]
    first: dt.date
    last: dt.date


def scope(spark: SparkSession, sf_dir: str) -> Scope:
    media = F.concat(F.lit("m"), (content_key() % 5).cast("string"))
    found = table(spark, sf_dir, "events").agg(
        F.array_sort(F.collect_set(media)).alias("media"),
        F.to_date(F.min("ts")).alias("first"),
        F.to_date(F.max("ts")).alias("last"),
    ).first()
    today = dt.date.today()
    return Scope(found["media"], found["first"] or today, found["last"] or today)


def content_key() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the source sends it: nine required fields, plus the key ``k``.

    Titles and countries are looked up in plain tables, one after the other, so that
    Spark knows the size of each: it broadcasts a table below the threshold without
    moving the events, and otherwise shuffles and splits hot keys at run time.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "value", "cast(get_json_object(props, '$.k') as int) as k"
    )
    titles = table(spark, sf_dir, "part").selectExpr("p_partkey as k", "p_name")
    homes = table(spark, sf_dir, "customer").selectExpr("c_custkey as user_id", "c_nationkey")
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey as c_nationkey", "n_name")
    # an event without a match stays, with NULLs
    looked_up = events.join(titles, "k", "left").join(homes, "user_id", "left").join(nations, "c_nationkey", "left")
    return looked_up.selectExpr(
        "cast(event_id as string) as event_key",
        "ts as received_at",
        "concat('v', cast(user_id as string)) as visitor_key",
        "concat('m', cast(k % 5 as string)) as media_id",
        "concat(p_name, case when k % 2 = 0 then ' Youtube' else ' FACEBOOK' end, ' Paid Ads')"
        " as media_name",
        "concat('https://example.com/medias/m', cast(k % 5 as string)) as media_url",
        "value / 100 as percent_viewed",
        "concat('10.0.', cast(user_id % 256 as string), '.', cast(k as string)) as ip",
        "n_name as country",
        "k",
    )


def plain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire_events(spark, sf_dir).drop("k")


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that keep the contract: the range rule for shares quarantines about one in eight of the table's."""
    return plain_events(spark, sf_dir).filter(F.col("percent_viewed").between(0, 1))


def first_load(events: DataFrame) -> DataFrame:
    end = F.lit(str(LOADED_THROUGH + dt.timedelta(days=1))).cast("timestamp_ntz")
    return events.filter(F.col("received_at") < end)


def correction(events: DataFrame) -> DataFrame:
    """A later delivery that overlaps the first one and changes shares, titles and places."""
    start = F.lit(str(CORRECTED_FROM)).cast("timestamp_ntz")
    return events.filter(F.col("received_at") >= start).withColumns(
        {
            "percent_viewed": F.col("percent_viewed") / 2,
            "media_name": F.concat(F.lit("New "), "media_name"),
            "country": F.concat(F.lit("NEW_"), "country"),
        }
    )


@dataclass(frozen=True)
class Model:
    fact: DataFrame
    media: DataFrame
    visitors: DataFrame
    engagement: DataFrame

    def enriched(self) -> DataFrame:
        return enrich(self.engagement, self.media, self.visitors, unique=True)


def model(spark: SparkSession, sf_dir: str) -> Model:
    events = valid_events(spark, sf_dir)
    fact = fact_media_engagement(events)
    return Model(fact, dim_media(events), dim_visitors(events), visitor_engagement(fact))


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, media_id, value)``: every event as a JSON line, some of them broken.

    The fault depends on the content key ``k``; the values without a case stay as they
    are (and break the range rule where their share does).
    """
    stamp = """date_format(received_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""
    members = [
        f"""case k when 7 then null when 23 then concat('"event_key":', event_key)
            else {member("event_key", "event_key")} end""",
        f"""case k when 13 then '"received_at":"yesterday"'
            when 14 then '"received_at":"2024-02-30T10:00:00Z"'
            when 28 then '"received_at":"2024"' else {member(stamp, "received_at")} end""",
        f"""case k when 9 then '"visitor_key":null'
            else {member("visitor_key", "visitor_key")} end""",
        f"case k when 7 then null else {member('media_id', 'media_id')} end",
        f"""case k when 9 then '"media_name":null' else {member("media_name", "media_name")} end""",
        member("media_url", "media_url"),
        f"""case k when 11 then '"percent_viewed":"0.5"' when 12 then '"percent_viewed":true'
            when 25 then '"percent_viewed":NaN'
            else {member("percent_viewed", "percent_viewed")} end""",
        f"""case k when 8 then '"ip":null' else {member("ip", "ip")} end""",
        f"case when k in (6, 26) then null else {member('country', 'country')} end",
        """case when k = 10 then '"lat":"north"'
            when k between 30 and 49 then '"lat":52.5,"lon":13' end""",
        """case k when 15 then '"conversion_type":false' when 16 then '"conversion_type":7'
            when 17 then '"conversion_type":"form"' end""",
        """case when k = 18 then '"thumbnail":"small"'
            when k = 19 then '"thumbnail":{"url":"u","width":1.0}'
            when k = 21 then '"thumbnail":{"url":"u","new_size":9}'
            when k between 30 and 49
              then '"thumbnail":{"url":"u","width":1,"height":2,"type":null}' end""",
        """case when k = 20
              then '"user_agent_details":{"browser":"b","mobile":"yes","os":"o"}'
            when k between 30 and 49
              then '"user_agent_details":{"browser":"b","mobile":false}' end""",
        """case when k in (21, 26) then '"new_field":{"a":[1]}' end""",
        """case k when 22
            then '"email":null,"lat":null,"thumbnail":null,"conversion_type":null' end""",
    ]
    whole = "concat('{', body, '}')"
    line = f"""case k when 1 then concat('{{', body) when 2 then concat({whole}, ' trailing')
        when 3 then '' when 4 then concat('[', {whole}, ']') when 5 then '"text"'
        when 27 then concat({whole}, char(13)) else {whole} end"""
    lines = wire_events(spark, sf_dir).selectExpr(
        "cast(event_key as bigint) as event_id", "media_id", "k",
        f"concat_ws(',', {', '.join(members)}) as body",
    )
    return lines.selectExpr("event_id", "media_id", f"{line} as value")
