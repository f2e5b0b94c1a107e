"""Token ids in a compact file format: canonical length-limited Huffman codes from global counts.

A file set is a Parquet folder with one row a block. A block holds the ids of whole consecutive documents as one run of
bits, with the bit offset of every STRIDE-th id, and can be decoded alone with the code lengths of the set (`codes`).
Blocks are in ascending doc_id order: by shard, then by block.

Tokenizing is most of the work, so it is done once, into a table of plain ids that the files are made from. A task
counts the ids as it makes them and adds the counts as its last row. It tokenizes each distinct piece of a run of texts
once, and a worker keeps the ids of pieces it has seen, up to a number of bytes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import huffman, words
from llm.spark import input_bytes, new_folder, partitions, table, written

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Ids after which a block is closed; a document is never cut.
BLOCK = 1 << 18
#: Bytes of pieces and their ids that a worker remembers.
MEMORY = 24 << 20
#: Bytes of input a shard of the files stands for.
SHARD_BYTES = 64 << 20
BLOCKS = "shard int, block int, before long, n_tokens long, doc_ids binary, no_ids binary, counts binary, bits binary, checkpoints binary"

#: White space as the tokenizer's own pattern has it. Fixed values.
_WHITE = r"\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: A space inside a run of white space; only at other spaces do pieces of a text stand alone.
_RUN = f"[{_WHITE}] ([{_WHITE}]|$)"
_ODD = f"^[{_WHITE}]|[{_WHITE}]$|^$"


class Encoder:
    """Whole texts to ids, piece by piece where spaces cut a text as the tokenizer's own pattern does."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = np.zeros(self.size, dtype=bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.known = words.Remembered(pa.string(), np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def _encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids) of pieces that follow a space.

        Many are encoded as one text and cut where a space begins an id; those with white space at an end on their own.
        """
        odd = pc.match_substring_regex(pieces, _ODD).to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        texts = pieces.take(pa.array(order)).to_pylist()
        tidy = len(texts) - int(odd.sum())
        sizes, flat = [], []
        for i in range(0, tidy, 256):
            some = texts[i : min(i + 256, tidy)]
            ids = self._encode([" " + " ".join(some)])[0]
            first = np.flatnonzero(self.spaced[ids])
            if len(first) == len(some) and first[0] == 0:
                sizes.append(np.diff(np.append(first, len(ids))))
                flat.append(ids)
            else:
                alone = self._encode([" " + x for x in some])
                sizes.append([len(x) for x in alone])
                flat += alone
        alone = self._encode([" " + x for x in texts[tidy:]])
        sizes.append([len(x) for x in alone])
        flat += alone
        size = np.concatenate(sizes).astype(np.int64)
        back = np.argsort(order, kind="stable")
        begins = np.cumsum(size) - size
        every = np.concatenate([*flat, np.zeros(0, dtype=np.uint32)])
        return size[back], every[words.stretches(begins[back], size[back])]

    def distinct(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(items of each text, of each item its piece, of each piece the number and place of its ids, ids): texts as items in turn."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _RUN)
        for special in self.specials:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        whole = whole.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        per = np.diff(np.asarray(lists.offsets)).astype(np.int64)
        begins = np.concatenate(([0], np.cumsum(per)[:-1]))
        # a text's first piece has no space before it; a text that spaces do not cut is one piece
        firsts = self._encode(pc.if_else(pa.array(whole), texts, lists.flatten().take(pa.array(begins))).to_pylist())
        coded = lists.flatten().dictionary_encode()
        size, begin, flat = self.known.look_up(coded.dictionary, self._encode_pieces, MEMORY)
        own = np.array([len(x) for x in firsts], dtype=np.int64)
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        index[begins] = len(size) + np.arange(len(texts))
        begin = np.concatenate((begin, len(flat) + np.cumsum(own) - own))
        return per, index, np.concatenate((size, own)), begin, np.concatenate((flat, *firsts))

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text with `end` after it, all ids)."""
        per, index, size, begins, flat = self.distinct(texts)
        each = size[index]
        row = np.repeat(np.arange(len(per)), per)
        counts = np.bincount(row, weights=each, minlength=len(per)).astype(np.int64)
        return counts + 1, np.insert(flat[words.stretches(begins[index], each)], np.cumsum(counts), end)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One a worker."""
    return Encoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _runs(texts: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Texts of a batch in runs of some megabytes, long enough for pieces to repeat."""
    ends = np.cumsum(pc.binary_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + size)))
        yield first, texts.slice(first, last - first)
        first = last


def _packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each, or in four behind an odd byte if one needs them."""
    return ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\0" + ids.astype("<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[1:], "<u4") if len(raw) % 2 else np.frombuffer(raw, "<u2").astype(np.uint32)


def tokenized(docs: DataFrame, path: str, end: int = END_ID) -> DataFrame:
    """(doc_id, ids, counts) of docs(doc_id, text) as a written table: ids with the end id, packed.

    Rows without ids, one a task, hold how often each id occurs in the task's other rows.
    """

    def run(batches):
        names, kinds = ["doc_id", "ids", "counts"], (pa.int64(), pa.binary(), pa.binary())
        total = np.zeros(0, dtype=np.int64)
        words.give_back()
        for batch in batches:
            for first, texts in _runs(batch["text"]):
                counts, ids = _encoder(path).ids(texts, end)
                new = np.bincount(ids, minlength=len(total))
                new[: len(total)] += total
                total = new
                ends = np.cumsum(counts)
                raw = pa.array([_packed(ids[b - n : b]) for b, n in zip(ends, counts, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(texts)), raw, pa.nulls(len(texts), pa.binary())], names=names)
        words.give_back()
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((None, None, total.astype("<i8").tobytes()), kinds, strict=True)], names=names)

    return written(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, counts binary"), "ids")


def id_counts(plain: DataFrame) -> np.ndarray:
    """How often each id occurs in a table of `tokenized`; the tasks' rows are summed in tasks, to one a partition."""

    def add(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch["counts"]:
                new = np.frombuffer(raw.as_buffer(), dtype="<i8")
                total = np.concatenate((total, np.zeros(max(0, len(new) - len(total)), np.int64)))
                total[: len(new)] += new
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = plain.where("counts is not null").select("counts").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(max([0, *rows["id"].to_pylist()]) + 1, dtype=np.int64)  # at most one row an id of the vocabulary
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = END_ID) -> None:
    """Write the ids of docs(doc_id, text) to `folder`/blocks, and the code lengths to `folder`/codes.

    A null text is empty, a null doc_id comes first, rows of one doc_id follow each other in an order that only their
    ids decide; other columns are left aside. An empty table gives a file set without blocks. Shards are ranges of
    doc_id, ids and row, so that neither rows without a doc_id nor those of one doc_id have to share a shard.
    """
    spark = docs.sparkSession
    plain = tokenized(docs, path, end)
    lengths = huffman.code_lengths(id_counts(plain))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/codes")

    def encode(batches):
        code = huffman.codes(lengths)
        shard = TaskContext.get().partitionId()
        block, before, held = 0, 0, 0
        open_: list[tuple[np.ndarray, ...]] = []

        def close():
            nonlocal block, before, held, open_
            doc_ids, without, counts, ids = (np.concatenate(x) for x in zip(*open_, strict=True))
            bits, checkpoints = huffman.encode(ids, lengths, code)
            row = [shard, block, before, len(ids), doc_ids.astype("<i8").tobytes(), np.packbits(without).tobytes(), counts.astype("<i8").tobytes(), bits, checkpoints]
            block, before, held, open_ = block + 1, before + len(ids), 0, []
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5)
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            doc_ids = pc.fill_null(batch["doc_id"], 0).to_numpy(zero_copy_only=False)
            without = pc.is_null(batch["doc_id"]).to_numpy(zero_copy_only=False)
            for k, raw in enumerate(batch["ids"]):
                ids = _unpacked(raw.as_py())
                open_.append((doc_ids[k : k + 1], without[k : k + 1], np.array([len(ids)]), ids))
                held += len(ids)
                if held >= BLOCK:
                    yield close()
        if open_:
            yield close()

    shards = max(partitions(spark), input_bytes(docs) // SHARD_BYTES)
    rows = plain.where("counts is null").select("doc_id", "ids", F.xxhash64("ids").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(shards, "doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "ids").select("doc_id", "ids")
    ordered.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of a file set; start: ids of all documents before."""
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/codes").first()["lengths"], dtype=np.uint8)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()  # one row for each 64 MB of input
    first, shard_start = 0, {}
    for r in sorted(totals, key=lambda r: r["shard"]):
        shard_start[r["shard"]], first = first, first + r["n"]
    extra = ", ids array<int>" if ids else ""

    def decode(batches):
        codes = huffman.decoding_table(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                found = huffman.decode(row["bits"], row["checkpoints"], row["n_tokens"], codes)
                counts = np.frombuffer(row["counts"], dtype="<i8")
                ends = np.cumsum(counts)
                begins = ends - counts
                raw = memoryview(found.astype("<u4").tobytes())
                doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
                without = np.unpackbits(np.frombuffer(row["no_ids"], dtype=np.uint8), count=len(doc_ids)).astype(bool)
                cols = [
                    pa.array(doc_ids, mask=without),
                    pa.array(shard_start[row["shard"]] + row["before"] + begins), pa.array(counts),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)], pa.int64()),
                ]
                if ids:
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    cols.append(pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + extra)


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write docs as tokens into the shared folder and read them back as digests."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(docs, folder, vocabulary or vocabulary_path())
    return read_tokens(spark, folder, ids=False)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
