import hashlib

import corpus
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import sentence_pieces
from llm.sentence_pieces import Pieces, decode, encode, model_path, op12_sentence_pieces

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=model_path())
PIECES = Pieces(model_path())
PARTS = ["a", "b", "e", "th", "he", "in", "ing", "The", " ", "  ", "     ", "▁", "\n", "é", "中", "😀", "\x00", "1", ".", "aaaa", "ﬁ", "<s>"]


def plain(text):
    return LIBRARY.encode(text or "", num_threads=1)


def own(texts):
    counts, ids = PIECES.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    return [ids[b - n : b].tolist() for b, n in zip(ends, counts, strict=True)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=30) | st.none(), max_size=6))
def test_ids_are_the_library_s(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    assert own(texts) == [plain(t) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 259, 28705]) | st.integers(3, 258) | st.integers(259, 31_999), max_size=12))
def test_texts_are_the_library_s(ids):
    assert PIECES.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("char", [" ", "a", "e", "-", "=", "中", "\n", "0"])
def test_runs_of_one_character(char):
    texts = [char * n for n in [*range(40), 1000, 3001]]
    assert own(texts) == [plain(t) for t in texts]


def test_single_steps_give_what_rounds_give():
    for word in ("▁internationalisation", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁the", "aaaaaaaaaaaaab"):
        symbols = [int(PIECES.char_id[np.searchsorted(PIECES.char, ord(c))]) for c in word]
        merged, _ = PIECES.merge(np.array(symbols), np.zeros(len(symbols), dtype=np.int64))
        assert PIECES._steps(symbols) == merged.tolist()


def test_a_very_long_text():
    text = "the cat, sat 12 on  a mat\n" * 100_000 + "x" * 100_000 + " " * 50_000
    assert own([text, "and more"]) == [plain(text), plain("and more")]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MEMORY", 700)
    texts = ["the cat and the dog", None, "", "and the cat"] * 2
    assert own(texts) == [plain(t) for t in texts]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{corpus.SF}/documents.parquet").collect()
    found = {tuple(r) for r in op12_sentence_pieces(spark, corpus.SF).collect()}
    ids = {r.doc_id: plain(r.text) for r in docs}
    assert found == {(i, len(x), digest(",".join(map(str, x))), digest(LIBRARY.decode(x))) for i, x in ids.items()}


def test_edges(spark):
    rows = decode(encode(corpus.edge_docs(spark), model_path()), model_path()).collect()
    expected = [(r[0], plain(r[1]), LIBRARY.decode(plain(r[1]))) for r in corpus.edge_rows()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert encode(corpus.no_docs(spark), model_path()).collect() == []
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), model_path()).first().decoded == ""
