import random

import corpus
import numpy as np
import pyarrow as pa
import pytest

from llm import decontamination
from llm.decontamination import MAX_EDITS, best_window, find_leaks, leaks, op8_decontamination, prepare, without_leaks, word_hashes


def plain_words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else " " if c.isascii() and not c.isalnum() else c for c in text or "").split()


def test_best_window_equals_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        item, text = ([rng.randrange(4) for _ in range(rng.randrange(n))] for n in (8, 12))
        distance, a, b = best_window(np.array(item, np.uint64), np.array(text, np.uint64))
        windows = [text[i:j] for i in range(len(text) + 1) for j in range(i, len(text) + 1)]
        assert distance == min(corpus.edit_distance(item, w) for w in windows) == corpus.edit_distance(item, text[a:b])


@pytest.mark.parametrize(("rate", "least"), [(0.0, 1.0), (0.1, 0.99), (0.2, 0.97), (0.25, 0.95)])
def test_recall_of_edited_items(rate, least):
    rng = random.Random(int(rate * 100))
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 5)))
    texts = [" ".join(word() for _ in range(rng.randrange(12, 70))) for _ in range(100)]
    items = prepare(list(range(100)), texts)
    found = 0
    for k, text in enumerate(texts):
        own = text.split()
        for _ in range(int(rate * len(own))):
            at, how = rng.randrange(len(own)), rng.random()
            own[at : at + (how < 0.7)] = [word()] if how < 0.4 or how >= 0.7 else []
        text = " ".join([word() for _ in range(rng.randrange(80))] + own + [word() for _ in range(rng.randrange(80))])
        found += any(item == k for _, item, *_ in leaks(items, pa.array([text]), MAX_EDITS))
    assert found / len(texts) >= least


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: plain_words(r.text) for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").collect()}
    items = {r.item_id: plain_words(r.text) for r in spark.read.parquet(f"{corpus.SF}/benchmark.parquet").collect()}
    expected = {}
    for i, own in docs.items():
        for k, item in items.items():
            if len(set(own) & set(item)) >= len(set(item)) * 0.5 and (d := corpus.best_infix(item, own)) <= MAX_EDITS * len(item):
                expected[i, k] = d
    rows = op8_decontamination(spark, corpus.SF).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in rows} == expected and expected
    for r in rows:
        window = docs[r.doc_id][r.start : r.start + r.n_words]
        assert corpus.edit_distance(items[r.item_id], window) == r.distance


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 2)  # several passes
    passage = "w0 w1, w2 W3 w4 w5 w6 w7 w8 w9"
    benchmark = spark.createDataFrame([(1, passage, "x"), (2, None, None), (None, passage, None), (3, "", None), (4, "one two", None), (5, passage, None)], "item_id long, text string, doc_id string")
    docs = corpus.edge_docs(spark)
    found = {(r.doc_id, r.item_id, r.distance) for r in find_leaks(docs, benchmark).collect()}
    assert found == {(i, k, 0) for i in (8, 9, 10, -5) for k in (1, 5)}
    clean = without_leaks(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(corpus.edge_rows()) - 4
    assert find_leaks(corpus.no_docs(spark), benchmark).collect() == [] and without_leaks(corpus.no_docs(spark), benchmark).collect() == []
    none = benchmark.limit(0)
    assert find_leaks(docs, none).collect() == [] and without_leaks(docs, none).count() == len(corpus.edge_rows())


def test_an_item_without_its_first_words_is_found_in_every_row():
    passage = [f"w{i}" for i in range(40)]
    items = prepare([7], [" ".join(passage)])
    for cut in range(int(MAX_EDITS * len(passage)) + 1):
        text = " ".join([*passage[cut:], "and", "more"])
        found = list(leaks(items, pa.array([text, "none of it", text]), MAX_EDITS))
        assert found == [(row, 0, cut, 0, 40 - cut) for row in (0, 2)]


def test_words_are_those_of_the_docstring():
    texts = ["A,b  c-D\x0beé 中!", None, "", "..."]
    per, hashes = word_hashes(pa.array(texts))
    assert per.tolist() == [len(plain_words(t)) for t in texts] and len(hashes) == per.sum()
