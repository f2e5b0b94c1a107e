import corpus
import pytest

from pyspark.sql import functions as F

from llm.mixing import SEED, mix, op2_mix_sources, shares, sizes
from llm.spark import with_row_key


def plain_targets(sizes: dict, budget: float) -> dict:
    """Water filling, one source at a time."""
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [5, 2, 1] * len(sizes), strict=False))
    targets, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        left = budget - sum(targets[s] for s in sizes if s not in open_)
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > 3 * sizes[s]}
        for s in over or open_:
            targets[s] = 3.0 * sizes[s] if over else share * weights[s]
        open_ -= over or set(open_)
    return targets


def check(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    sizes = {s: sum(r.size for r in own) for s, own in by.items()}
    targets = plain_targets(sizes, sum(sizes.values()))
    for s, own in by.items():
        assert {r.source_size for r in own} == {sizes[s]}
        assert own[0].target == pytest.approx(targets[s])
        assert abs(sum(r.taken for r in own) - targets[s]) <= 2 * max(r.size for r in own) + 1
    assert sum(r.taken for r in rows) <= sum(sizes.values())


def test_query_meets_targets_and_repeats_itself(spark):
    rows = op2_mix_sources(spark, corpus.SF).collect()
    check(rows)
    assert sorted(map(str, rows)) == sorted(map(str, op2_mix_sources(spark, corpus.SF).collect()))


def plain_taken(docs: list[tuple], draws: dict) -> dict:
    """doc_id -> words taken: all passes of all documents in the order of their finish times, until the budget is full."""
    sizes: dict = {}
    for i, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(corpus.words(text))
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [5.0, 2.0, 1.0] * len(sizes), strict=False))
    entries, upto = [], dict.fromkeys(sizes, 0)
    for i, text, source in sorted(docs, key=lambda d: draws[d[0]]):
        n = len(corpus.words(text))
        upto[source] += n
        entries += [((sizes[source] * k + upto[source]) / weights[source], n, i) for k in range(3) if n]
    left, taken = sum(sizes.values()), {i: 0 for i, _, _ in docs}
    for _, n, i in sorted(entries):
        if n > left:
            break
        left -= n
        taken[i] += n
    return taken


def test_documents_are_taken_in_the_order_of_their_finish_times(spark):
    table = spark.read.parquet(f"{corpus.SF}/documents.parquet")
    docs = [(r.doc_id, r.text, r.source) for r in table.collect()]
    draws = {r.doc_id: r.d for r in table.selectExpr("doc_id", f"xxhash64({SEED}, doc_id) as d").collect()}
    assert {r.doc_id: r.taken for r in op2_mix_sources(spark, corpus.SF).collect()} == plain_taken(docs, draws)


def test_rows_without_ids_are_dealt_over_ranges(spark):
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat('w ', id % 900) as text", "'s' as source")
    rows, _ = with_row_key(docs, "row")
    none = [r["count"] for r in sizes(rows, "row").where("doc_id is null").groupBy(F.expr("shiftright(draw, 61)")).count().collect()]
    assert len(none) == 8 and max(none) < 2 * sum(none) / 8
    check(shares(docs).collect())


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * 10, "b") for i in range(300)] + [(1000 + i, "w " * 5, "a") for i in range(4)] + [(2000, None, None), (2001, "x", None)]
    found = shares(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check(found)
    assert all(r.passes == 3 for r in found if r.source == "a")


def test_ranges_do_not_change_the_mix(spark, monkeypatch):
    from llm import mixing

    one = op2_mix_sources(spark, corpus.SF).collect()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    many = op2_mix_sources(spark, corpus.SF).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_edges(spark):
    docs = corpus.edge_docs(spark)
    check(shares(docs).collect())
    assert shares(docs).count() == len(corpus.edge_rows())
    taken = mix(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.passes for r in shares(docs).collect())
    assert shares(corpus.no_docs(spark)).collect() == [] and mix(corpus.no_docs(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in shares(blank).collect()] == [(0.0, 0), (0.0, 0)]
