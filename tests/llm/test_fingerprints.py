import hashlib

import corpus
import pytest

from llm import fingerprints
from llm.fingerprints import edited_pairs, op9_fingerprints


def jaccard(a, b):
    shingle = lambda t: {tuple(w[i : i + 5]) for w in [corpus.words(t)] for i in range(max(1, len(w) - 4))} if corpus.words(t) else set()
    a, b = shingle(a), shingle(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("size", [1 << 24, 20_000])
def test_query_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").collect())
    found = {r.doc_id: r for r in op9_fingerprints(spark, corpus.SF).collect()}
    assert len(found) == len(docs)
    wrong, same = [], {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        wrong += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert same.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    assert max(map(abs, wrong)) < 0.2 and abs(sum(wrong) / len(wrong)) < 0.02


@pytest.mark.parametrize("size", [1 << 24, 200])
def test_next_of_rows_that_share_ids_or_have_none(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    docs = corpus.odd_ids(spark)
    rows = [(i, t or "") for _, i, t in corpus.ranked(docs.na.fill(""))]
    expected = [(i, t[: len(t) - len(t) // 2] + n[: len(t) // 2]) for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True)]
    assert sorted(((r.doc_id, r.edited) for r in edited_pairs(docs).collect()), key=str) == sorted(expected, key=str)


def test_edges(spark):
    rows = edited_pairs(corpus.edge_docs(spark)).collect()
    assert len(rows) == len(corpus.edge_rows())
    by = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == "" and by[1][0].near_next == 1.0  # two texts without words
    assert by[5][0].fingerprint == by[6][0].fingerprint == by[6][1].fingerprint and len(by[5][0].fingerprint) == 256
    assert by[5][0].near_next == 1.0 and by[4][0].near_next < 0.2
    assert edited_pairs(corpus.no_docs(spark)).collect() == []
    one = spark.createDataFrame([(None, "abcd")], "doc_id long, text string")
    assert [r.edited for r in edited_pairs(one).collect()] == ["abab"]


def test_main_path_has_no_python(spark):
    plan = op9_fingerprints(spark, corpus.SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
