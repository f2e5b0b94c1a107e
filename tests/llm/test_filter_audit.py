import itertools
from collections import Counter, defaultdict

import compare
import corpus
import pytest

from llm.filter_audit import LETTERS, PIECE, SQL, Limits, audit, cells, op13_filter_audit, word_counts

LABELS = "doc_id long, quality int, toxic int, id int, part string"


def plain_masks(docs, limits=Limits()):
    first = {}
    for i, text, _ in docs:
        rank = (i is not None, i or 0)
        first[text or ""] = min(rank, first.get(text or "", rank))
    for i, text, lang in docs:
        text = text or ""
        own = corpus.words(text)
        failed = (
            len(own) < limits.words, 100 * len(set(own)) < limits.distinct * len(own),
            100 * sum("A" <= c <= "Z" for c in text) > limits.upper * len(text), any(c in limits.signs for c in text),
            (i is not None, i or 0) > first[text],
        )
        yield i, lang or "", failed


def plain_audit(docs, labels, limits=Limits()):
    """(part, order, step) -> the measures, each document taken through every order."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    out = defaultdict(Counter)
    parts = Counter()
    for i, part, failed in plain_masks(docs, limits):
        parts[part] += 1
        for order in itertools.permutations(range(5)):
            gone = False
            for step, letter in enumerate(order, 1):
                cell = out[part, "".join(LETTERS[k] for k in order), step]
                cell["unique"] += failed[letter] and sum(failed) == 1
                cell["redundant"] += failed[letter] and gone
                if failed[letter] and not gone:
                    gone = True
                    cell["removed"] += 1
                    cell["good"] += i in good
                    cell["toxic"] += i in toxic
                    out[part, LETTERS[letter]]["shapley"] += 1
                cell["kept"] += not gone
    found = set()
    for key in [k for k in out if len(k) == 3]:
        c = out[key]
        found.add((*key, c["kept"], c["removed"], c["redundant"], c["unique"], c["good"], c["toxic"], out[key[0], key[1][key[2] - 1]]["shapley"]))
    return found


def test_query_equals_its_sql(spark):
    assert compare.difference(op13_filter_audit(spark, corpus.SF), compare.connect(corpus.SF), SQL) == ""


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{corpus.SF}/labels.parquet").collect()]
    rows = op13_filter_audit(spark, corpus.SF).collect()
    assert [*rows[0].asDict()] == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert {tuple(r) for r in rows} == plain_audit(docs, labels)
    assert len(rows) == 600 * len({lang for _, _, lang in docs})


def test_edges(spark):
    """Null and repeated ids, texts, languages and labels, columns with the names of measures, labels of no document."""
    labels = [(i, q, t, 1, "z") for i, q, t in [(2, 1, 0), (6, None, 1), (6, 1, None), (None, 1, 1), (3, 0, 0), (99, 1, 1), (9, 1, 1)]]
    docs = corpus.edge_docs(spark).selectExpr("*", "1 as mask", "2 as digest", "3 as n", "4 as good", "5 as quality", "6 as step")
    limits = Limits(words=20, distinct=90)
    rows = audit(cells(docs, spark.createDataFrame(labels, LABELS), limits)).collect()
    plain = [(r[0], r[1], r[2]) for r in corpus.edge_rows()]
    assert {tuple(r) for r in rows} == plain_audit(plain, [x[:3] for x in labels], limits)
    assert len(rows) == 600 * len({p or "" for _, _, p in plain})


def test_equal_rows_and_null_ids_do_not_repeat_themselves(spark):
    docs = [(None, "same"), (None, "same"), (1, "same"), (2, "own"), (2, "own"), (3, "own"), (4, None), (5, "")]
    rows = [(i, t, "en") for i, t in docs]
    counted = cells(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([], LABELS))
    assert sorted((r.mask, r.documents) for r in counted.collect()) == [(1, 5), (17, 3)]
    assert {tuple(r) for r in audit(counted).collect()} == plain_audit(rows, [])


def test_no_documents(spark):
    assert audit(cells(corpus.no_docs(spark), spark.createDataFrame([], LABELS))).collect() == []


@pytest.mark.parametrize("text", ["", " ", "a b a", "x " * PIECE, "é" * (2 * PIECE) + " é\n" * 5])
def test_long_texts_are_counted_piece_by_piece(text):
    assert word_counts(text.encode()) == (len(corpus.words(text)), len(set(corpus.words(text))))


def test_fewer_letters(spark):
    counted = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 0, 2, 0, 0)], "part string, mask int, documents long, good long, toxic long")
    rows = {(r.filter_order, r.step): r for r in audit(counted, "AB").collect()}
    assert len(rows) == 4 and rows["AB", 1].removed == 5 and rows["AB", 2].redundant == 5 and rows["BA", 2].kept == 2 and rows["BA", 2].shapley == 5
