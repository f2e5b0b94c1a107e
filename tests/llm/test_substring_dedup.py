import random

import compare
import corpus
import pytest

from llm import packed, substring_dedup
from llm.substring_dedup import COVERS, dedup, op1_substring_dedup, period_for


@pytest.mark.parametrize("period", COVERS)
def test_covers_reach_every_pair_of_residues(period):
    cover = COVERS[period]
    for i in range(period):
        assert any((s % period) in cover and ((s + i) % period) in cover for s in range(period))


def test_period_leaves_room_for_an_anchor():
    assert period_for(20) == 13 and period_for(1) == 1 and period_for(2) == 1


def test_query_equals_sql(spark):
    assert compare.difference(op1_substring_dedup(spark, corpus.SF), compare.connect(corpus.SF), substring_dedup.SQL) == ""


@pytest.mark.parametrize("window", [1, 2, 5, 20])
def test_short_alphabet_equals_brute_force(spark, window):
    rng = random.Random(window)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(40)]
    docs += [(i, "a " * 50) for i in range(100, 104)]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in dedup(spark.createDataFrame(docs, "doc_id long, text string"), window).collect()}
    assert found == corpus.plain_window_dedup(docs, window)


def test_edges(spark):
    for docs in (corpus.edge_docs(spark), corpus.odd_ids(spark)):
        rows = corpus.ranked(docs)
        plain = corpus.plain_window_dedup([(k, t) for k, _, t in rows])
        expected = sorted(((i, *plain[k]) for k, i, _ in rows), key=str)
        assert sorted(map(tuple, dedup(docs).collect()), key=str) == expected
    assert dedup(corpus.no_docs(spark)).collect() == []


def test_bytes_by_plane_come_back():
    import numpy as np

    x = np.array([1, -5, 2**40], dtype=np.int64)
    assert (packed.unplanes(packed.planes(x), np.int64) == x).all()
