import pytest

from viewlake.errors import GateError, InputError
from viewlake.operators.latest import latest_per_key
from viewlake.operators.upsert import require_unique, upsert
from viewlake.sources import storage, tables
from viewlake.sources.tables import overwrite_table, read_table, table_exists, upsert_table

SCHEMA = "k string, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], SCHEMA)
    source = spark.createDataFrame([(5, "b"), (6, "c"), (7, None)], "v int, k string")
    merged = upsert(target, source, ["k"]).select("k", "v")
    assert rows(merged) == rows(
        spark.createDataFrame([("a", 1), ("b", 5), ("c", 6), (None, 3), (None, 7)], SCHEMA)
    )


def test_unique_gate(spark):
    require_unique(spark.createDataFrame([("a", 1), (None, 1), (None, 2)], SCHEMA), ["k"], "t")
    with pytest.raises(GateError, match="'a'"):
        require_unique(spark.createDataFrame([("a", 1), ("a", 2)], SCHEMA), ["k"], "t")


def test_table_life(spark, folder):
    with pytest.raises(InputError):
        read_table(spark, folder)
    empty = spark.createDataFrame([], SCHEMA)
    assert upsert_table(empty, folder, ["k"]) == 0
    assert not table_exists(spark, folder)

    first = [("a", 1), ("b", 2)]
    assert upsert_table(spark.createDataFrame(first, SCHEMA), folder, ["k"]) == 2
    assert upsert_table(spark.createDataFrame([("b", 5), (None, 0)], SCHEMA), folder, ["k"]) == 2
    assert upsert_table(spark.createDataFrame([("c", 6), ("b", 7), (None, 0)], SCHEMA), folder, ["k"]) == 3
    table, version = read_table(spark, folder)
    expected = rows(spark.createDataFrame([("a", 1), ("b", 7), ("c", 6), (None, 0), (None, 0)], SCHEMA))
    assert (rows(table), version, table.columns) == (expected, 2, ["k", "v"])

    assert upsert_table(empty, folder, ["k"]) == 0
    assert read_table(spark, folder)[1] == 2

    assert overwrite_table(spark.createDataFrame([], "k string, extra date"), folder) == 0
    table, version = read_table(spark, folder)
    assert (table.columns, table.count(), version) == (["k", "extra"], 0, 3)
    with pytest.raises(InputError):
        upsert_table(spark.createDataFrame([("a", None)], "k string, extra date"), folder, ["k"])


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, folder):
    everything = spark.range(2000).selectExpr("concat('k', id) k", "1 v")
    upsert_table(everything, folder, ["k"], buckets=8)
    before = set(storage.matching(spark, f"{folder}/rows-*/_bucket=*/part-*"))
    assert len({f.split("_bucket=")[1].split("/")[0] for f in before}) == 8
    upsert_table(spark.createDataFrame([("k17", 9)], SCHEMA), folder, ["k"])
    after = set(storage.matching(spark, f"{folder}/rows-*/_bucket=*/part-*"))
    touched = {f.split("_bucket=")[1].split("/")[0] for f in before ^ after}
    assert len(touched) == 1
    table = read_table(spark, folder)[0]
    assert table.count() == 2000 and table.filter("v = 9").collect() == [("k17", 9)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_a_batch_may_be_made_from_the_table_itself(spark, folder):
    upsert_table(spark.range(100).selectExpr("cast(id as string) k", "1 v"), folder, ["k"])
    table, _ = read_table(spark, folder)
    upsert_table(table.selectExpr("k", "v + 1 as v"), folder, ["k"])
    assert read_table(spark, folder)[0].groupBy("v").count().collect() == [(2, 100)]


@pytest.mark.parametrize("step", ["require_unique", "_require_schema", "upsert", "_log"])
@pytest.mark.parametrize("exists", [True, False])
def test_any_failure_leaves_the_table_as_it_was(spark, folder, monkeypatch, step, exists):
    if not exists and step in ("_require_schema", "upsert"):
        return  # not a step of a first load
    old = [("a", 1), ("b", 2)]
    if exists:
        upsert_table(spark.createDataFrame(old, SCHEMA), folder, ["k"])

    def broken(*args, **kwargs):
        raise RuntimeError("executors lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, broken)
        with pytest.raises(RuntimeError):
            upsert_table(spark.createDataFrame([("b", 5)], SCHEMA), folder, ["k"])
    assert table_exists(spark, folder) == exists
    if exists:
        assert read_table(spark, folder)[1] == 0
        if step != "_log":
            assert rows(read_table(spark, folder)[0]) == old
    # the same load, run again
    assert upsert_table(spark.createDataFrame([("b", 5)], SCHEMA), folder, ["k"]) == 1
    assert rows(read_table(spark, folder)[0]) == ([("a", 1)] if exists else []) + [("b", 5)]


def test_a_batch_with_repeated_keys_or_other_columns_is_refused(spark, folder):
    upsert_table(spark.createDataFrame([("a", 1)], SCHEMA), folder, ["k"])
    for batch, schema in (([("a", 2), ("a", 3)], SCHEMA), ([("b", 2, 3)], SCHEMA + ", w int")):
        with pytest.raises(GateError):
            upsert_table(spark.createDataFrame(batch, schema), folder, ["k"])
    assert rows(read_table(spark, folder)[0]) == [("a", 1)]
    with pytest.raises(GateError):
        upsert_table(spark.createDataFrame([("a", 1), ("a", 2)], SCHEMA), f"{folder}/new", ["k"])
    assert not table_exists(spark, f"{folder}/new")


def test_an_overwrite_keeps_the_folder_that_readers_may_hold(spark, folder):
    for v in (1, 2, 3):
        overwrite_table(spark.createDataFrame([("a", v)], SCHEMA), folder)
        if v == 2:
            held, _ = read_table(spark, folder)
    assert rows(held) == [("a", 2)] and rows(read_table(spark, folder)[0]) == [("a", 3)]
    assert len(storage.matching(spark, f"{folder}/rows-*")) == 2


def test_latest_per_key_orders_nulls_last_and_cuts_before_the_shuffle(spark):
    data = [("a", None, 1), ("a", 5, 2), ("a", 5, 3), ("b", None, 4), (None, 1, 5), (None, 2, 6)]
    frame = spark.createDataFrame(data, "k string, t int, v int").repartition(3)
    newest = latest_per_key(frame, ["k"], ["t", "v"])
    assert rows(newest) == sorted([("a", 5, 3), ("b", None, 4), (None, 2, 6)], key=str)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_upsert_shuffles_large_sources(spark, settings):
    """Beyond the broadcast threshold the result is the same."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    target = spark.range(1000).selectExpr("cast(id as string) k", "1 v")
    source = spark.range(900, 1100).selectExpr("cast(id as string) k", "2 v")
    merged = upsert(target, source, ["k"])
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.groupBy("v").count().orderBy("v").collect() == [(1, 900), (2, 200)]
