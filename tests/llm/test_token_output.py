import random
import zlib

import corpus
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import huffman, token_output
from llm.token_output import Encoder, encoded, op7_token_output, read_tokens, vocabulary_path, write_tokens

ENCODER = Encoder(vocabulary_path())


def plain_ids(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def split(counts, ids):
    ends = np.cumsum(counts)
    return [ids[b - n : b].tolist() for b, n in zip(ends, counts, strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1.é中'\n\t\x0b\x1c\x85\xa0  "), max_size=12) | st.just("a  <|endoftext|> b"), min_size=1, max_size=5))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert split(*ENCODER.ids(pa.array(texts), 2)) == [plain_ids(t) for t in texts]


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_output, "MEMORY", 700)
    texts = ["the cat and the dog", None, "", "and the cat"] * 2
    assert split(*ENCODER.ids(pa.array(texts), 2)) == [plain_ids(t) for t in texts]


@pytest.mark.parametrize(("n", "k"), [(1, 3), (2, 700), (50257, 60_000), (70_000, 300_000), (40, 5000)])
def test_codes_come_back_and_are_short(n, k):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, k) - 1, n - 1).astype(np.uint32)
    counts = np.bincount(ids, minlength=n)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= max(16, int(np.count_nonzero(counts) - 1).bit_length())
    assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
    bits, checkpoints = huffman.encode(ids, lengths, huffman.codes(lengths))
    assert (huffman.decode(bits, checkpoints, len(ids), huffman.decoding_table(lengths)) == ids).all()


def test_limited_codes_are_as_short_as_can_be():
    def best(counts, limit):  # all lengths that satisfy Kraft's sum
        import itertools

        return min(sum(c * n for c, n in zip(counts, x, strict=True)) for x in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0**-n for n in x) <= 1)

    rng = random.Random(1)
    for _ in range(20):
        counts = [rng.choice([1, 2, 5, 40, 300]) for _ in range(5)]
        lengths = huffman.code_lengths(np.array(counts), 3)
        assert sum(c * int(n) for c, n in zip(counts, lengths, strict=True)) == best(counts, 3)


def expected(docs):
    at, out = 0, {}
    for doc_id, text in sorted(docs):
        ids = plain_ids(text)
        out[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("block", [1 << 18, 1000])
def test_query_equals_the_library(spark, monkeypatch, block):
    monkeypatch.setattr(token_output, "BLOCK", block)
    monkeypatch.setattr(token_output, "SHARD_BYTES", block << 4)
    docs = [tuple(r) for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op7_token_output(spark, corpus.SF).collect()}
    assert found == expected(docs)


def test_a_third_without_ids_is_dealt_out(spark, folder, monkeypatch):
    """Also where they are copies of one text, and where a third of all rows has one id."""
    monkeypatch.setattr(token_output, "partitions", lambda spark: 12)
    docs = spark.range(6000).selectExpr(
        "case id % 3 when 0 then null when 1 then 7 else id end as doc_id", "if(id % 2 = 0, 'one and the same text', concat('text ', id)) as text"
    )
    write_tokens(docs, folder, vocabulary_path())
    shards = [r.n for r in spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg({"n_tokens": "sum"}).toDF("shard", "n").collect()]
    assert len(shards) == 12 and max(shards) < 3 * sum(shards) / 12
    rows = read_tokens(spark, folder, ids=False).collect()
    assert sum(r.doc_id is None for r in rows) == 2000 and len(rows) == 6000
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)


def test_smallest_id_stays(spark, folder):
    docs = spark.createDataFrame([(-(2**63), "a"), (None, "b"), (2**63 - 1, "c")], "doc_id long, text string")
    write_tokens(docs, folder, vocabulary_path())
    rows = sorted(read_tokens(spark, folder, ids=False).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, -(2**63), 2**63 - 1]


def test_counts_are_those_of_all_ids(spark):
    docs = spark.read.parquet(f"{corpus.SF}/documents.parquet")
    plain = token_output.tokenized(docs, vocabulary_path())
    every = np.concatenate([plain_ids(r.text) for r in docs.collect()])
    assert token_output.id_counts(plain).tolist() == np.bincount(every).tolist()


def test_edges(spark, folder):
    write_tokens(corpus.edge_docs(spark), folder, vocabulary_path())
    rows = sorted(read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert len(rows) == len(corpus.edge_rows())
    order = sorted((r[0] is not None, r[0] or 0) for r in corpus.edge_rows())
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == order
    at = 0
    texts = {}
    for i, t, *_ in corpus.edge_rows():
        texts.setdefault(i, []).append(plain_ids(t))
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids in texts[r.doc_id]
        at += r.n_tokens
    assert encoded(corpus.no_docs(spark)).collect() == []
