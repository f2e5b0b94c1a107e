import math
import random

import compare
import corpus
import pytest

from llm import minhash_dedup
from llm.minhash_dedup import BANDS, BATCHES, ROWS, least_matches, near_duplicates, op5_minhash_dedup, without_near_duplicates
from llm.spark import components


def test_query_equals_sql(spark):
    assert compare.difference(op5_minhash_dedup(spark, corpus.SF), compare.connect(corpus.SF), minhash_dedup.SQL) == ""


def near_copies(seed, groups=6, size=14):
    rng = random.Random(seed)
    docs, i = [], 0
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(size):
            own = [w if rng.random() > rng.choice([0.0, 0.01, 0.03, 0.06]) else f"e{rng.randrange(10**6)}" for w in base]
            docs.append((i * 7919 % 1009, " ".join(own)))
            i += 1
    return docs


@pytest.mark.parametrize("unit", [512, 4])
def test_near_copies_equal_brute_force(spark, monkeypatch, unit):
    monkeypatch.setattr(minhash_dedup, "UNIT", unit)  # 4: groups are cut into bands, and bands into chunks
    docs = near_copies(unit)
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == corpus.plain_components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_edges(spark):
    for docs in (corpus.odd_ids(spark), corpus.edge_docs(spark)):
        rows = corpus.ranked(docs)
        plain = corpus.plain_components([(k, t) for k, _, t in rows])
        of_key = {k: i for k, i, _ in rows}
        expected = sorted(((i, plain[k][0], of_key[plain[k][1]], k == plain[k][1]) for k, i, _ in rows), key=str)
        assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == expected
        kept = sorted(((i, t) for k, i, t in rows if plain[k][1] == k), key=str)
        assert sorted(((r.doc_id, r.text) for r in without_near_duplicates(docs).collect()), key=str) == kept
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 12 not in ids and 4 in ids and 6 not in ids and {1, 2, 3} <= set(ids)
    assert near_duplicates(corpus.no_docs(spark)).collect() == []
    assert without_near_duplicates(corpus.no_docs(spark)).collect() == []


def test_texts_without_words_alone(spark):
    docs = spark.createDataFrame([(k, None if k % 2 else " \n") for k in range(4)], "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == [(k, 0, k, True) for k in range(4)]


def test_chosen_probabilities():
    assert (1 - 0.75**ROWS) ** BANDS < 1e-5
    for n in BATCHES:
        m = least_matches(n, 0.75, 1e-6)
        below = sum(math.comb(n + 1, k) * 0.75**k * 0.25 ** (n + 1 - k) for k in range(m))
        assert below < 1e-6 and m < n


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(5, 5), (2000, 2001), (2001, 2000)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1040), 1000), 2000: 2000, 2001: 2000}
