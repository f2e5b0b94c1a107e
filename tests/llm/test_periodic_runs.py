import hashlib
import random
import zlib

import corpus
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.periodic_runs import collapse, find_runs, frequent_segments, op11_periodic_runs, with_planted_runs


def plain_runs(own, repeats=4, least=6):
    """Every lag of every place: a stretch of equal words at the lag is a run if no smaller lag holds on all of it."""
    found, n = [], len(own)
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if own[i] != own[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and own[j] == own[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(own[k] == own[k + r] for k in range(i, i + length - r)) for r in range(1, q))
            if length >= max(least, repeats * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(own, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def planted(doc_id, text):
    own = corpus.words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not own:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def by_library(texts, repeats=4, least=6):
    names = {}
    ids = np.array([names.setdefault(w, len(names)) for t in texts for w in t], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.cumsum([0, *[len(t) for t in texts]])
    out = [[] for _ in texts]
    for at, n, q in find_runs(ids, row, repeats, least).T.tolist():
        out[row[at]].append((at - int(first[row[at]]), n, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 7)), max_size=6), max_size=4), st.sampled_from([(4, 6), (3, 1), (5, 12)]))
def test_runs_are_those_of_all_lags(parts, limits):
    texts = [list("".join(u * k for u, k in text)) for text in parts]
    assert by_library(texts, *limits) == [plain_runs(t, *limits) for t in texts]


def test_long_periods_and_nested_runs():
    rng = random.Random(2)
    for k in range(40):
        unit = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 70))]
        text = list("xyz") + unit * rng.randrange(3, 8) + unit[: rng.randrange(len(unit))] + ["c"] * rng.randrange(9) + list("ab" * k)
        assert by_library([text, text[::-1]]) == [plain_runs(text), plain_runs(text[::-1])]


def test_rare_words_split_until_nothing_changes():
    ids = np.array([1, 2] * 6 + [3] + [1, 4, 1, 4, 5] + [6] * 5 + [7, 7, 7, 7, 7, 7])
    places, segment = frequent_segments(ids, np.zeros(len(ids), dtype=np.int64), 4, 6)
    assert places.tolist() == [*range(12), *range(18, 29)]
    assert segment.tolist() == [0] * 12 + [1] * 11


def test_runs_do_not_cross_texts():
    assert by_library([["a"] * 5, ["a"] * 5, ["a"] * 6]) == [[], [], [(0, 6, 1)]]


def test_a_long_text_of_one_word_and_of_few_words():
    assert by_library([["a"] * 300_000]) == [[(0, 300_000, 1)]]
    rng = random.Random(3)
    text = [rng.choice("ab") for _ in range(50_000)]
    assert (0, 200_000, 50_000) in by_library([text * 4])[0]


def expected(doc_id, text):
    own = planted(doc_id, text)
    runs = plain_runs(own)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapse(own, runs))]
    return (doc_id, len(runs), s, n, q, n and 1000 * n // q, *digests)


def short_docs(spark):
    docs = spark.read.parquet(f"{corpus.SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in docs if len(r.text) < 12_000]


def test_query_equals_brute_force(spark):
    """Whole table through the query; texts of up to 12,000 characters are compared, as the plain version is quadratic."""
    found = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, corpus.SF).collect()}
    docs = short_docs(spark)
    assert len(found) >= len(docs) > 100
    assert [found[i] for i, _ in docs] == [expected(i, t) for i, t in docs]
    assert any(row[1] for row in found.values())


def test_edges(spark):
    rows = collapse(corpus.edge_docs(spark)).collect()
    plain = []
    for i, t, *_ in corpus.edge_rows():
        own = corpus.words(t)
        if len(own) > 2000:
            continue
        runs = plain_runs(own)
        plain.append((i, len(own), runs, plain_collapse(own, runs)))
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in rows]
    assert len(found) == len(corpus.edge_rows())
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    assert sorted([r for r in found if r[1] <= 2000], key=key) == sorted(plain, key=key)
    assert collapse(corpus.no_docs(spark)).collect() == []
    kept = {r.doc_id: r.text for r in with_planted_runs(corpus.edge_docs(spark)).collect() if r.doc_id is None}
    assert kept[None] in {"no id here at all", None}


def test_nothing_repeats_less_than_three_times(spark):
    with pytest.raises(ValueError, match="3 or more"):
        collapse(corpus.no_docs(spark), repeats=2)
