"""SentencePiece BPE ids of texts, and texts of ids, equal to the library's.

A text becomes one flat array of symbols, with every distinct word of a batch in it once. Words end where no piece can
reach across: before a space behind another character, and between characters that never stand side by side in a piece.
A round finds the best-ranked pair of each word (a segmented minimum), merges all its places at once from the left, and
compacts the array; words without a pair leave it, until none is left. A merge may make a pair that has to go before
the places still to be merged (runs of spaces, whose pieces have one rank; pieces ranked before their own parts). A round
looks for that, and such a word, which is rare, is merged step by step.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import sha256_hex, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of words, and of their ids, that a worker remembers.
MEMORY = 32 << 20
#: Texts that are decoded at once.
DECODED = 256
_NEVER = np.iinfo(np.int32).max
_EMPTY, _NO_PAIR = -1, -2
_SCATTER = np.uint64(0x9E3779B97F4A7C15)


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    """Each byte that is no part of a character becomes U+FFFD."""
    return "�", error.start + 1


codecs.register_error("llm.one_by_one", _one_by_one)


class Pieces:
    """A BPE model with byte fallback, as tables; the library only reads the file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        bytes_ = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(bytes_) < 256 or any(model.is_unused(i) for i in normal) or model.normalize(" a  AÅ ") != f"{SPACE * 2}a{SPACE * 2}AÅ{SPACE}":
            raise ValueError("Only models with byte fallback, without unused pieces, that keep texts as they are")
        self.of_byte = np.array([bytes_[b] for b in range(256)], dtype=np.int64)
        self.surface = [b"" if model.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.surface[model.unk_id()] = " ⁇ ".encode()
        for b, i in bytes_.items():
            self.surface[i] = bytes([b])
        self.silent = {i for i in range(n) if model.is_control(i)}
        self.spaced = {i for i in normal if names[i].startswith(SPACE)}
        # as a text's first piece, which loses a space, piece i is number n + i
        self.surfaces = pa.array(self.surface + [s[i in self.spaced :] for i, s in enumerate(self.surface)], pa.binary())
        self.size = n
        id_of = {names[i]: i for i in normal}
        rank = np.unique([-model.get_score(i) for i in range(n)], return_inverse=True)[1].astype(np.int64)
        pairs, reach = {}, {SPACE + SPACE}
        for piece, i in id_of.items():
            reach.update(piece[k : k + 2] for k in range(len(piece) - 1))
            for k in range(1, len(piece)):
                left, right = id_of.get(piece[:k]), id_of.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * n + right] = i
        # an open hash table of the pairs, at most a quarter full
        bits = (4 * len(pairs)).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.pair = np.full(1 << bits, _EMPTY, dtype=np.int64)
        self.merged = np.zeros(1 << bits, dtype=np.int64)
        slots = self._slots(np.array(list(pairs), dtype=np.int64)).tolist()
        for (key, i), slot in zip(pairs.items(), slots, strict=True):
            while self.pair[slot] != _EMPTY:
                slot = (slot + 1) & self.last
            self.pair[slot], self.merged[slot] = key, i
        self.rank = np.where(self.pair == _EMPTY, _NEVER, rank[self.merged]).astype(np.int32)
        self.cut_at_space = not any(b == SPACE and a != SPACE for a, b in reach)
        self.char = np.array(sorted(ord(c) for c in id_of if len(c) == 1), dtype=np.int64)
        self.char_id = np.array([id_of[chr(c)] for c in self.char], dtype=np.int64)
        self.reach = np.array(sorted(ord(a) << 32 | ord(b) for a, b in reach), dtype=np.int64)
        #: ASCII characters other than the space that no piece has beside others; words are cut around them.
        inside = {c for ab in reach for c in ab}
        self.alone = np.array([b < 128 and b != 32 and chr(b) not in inside for b in range(256)])
        self.known = words.Remembered(pa.large_binary(), np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SCATTER) >> self.shift).view(np.int64)

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; symbols below zero are in no pair."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, _NO_PAIR)
        slot = self._slots(key)
        found = self.pair[slot]
        open_ = np.flatnonzero((found != key) & (found != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.last
            found[open_] = self.pair[slot[open_]]
            open_ = open_[(found[open_] != key[open_]) & (found[open_] != _EMPTY)]
        return self.rank[slot], self.merged[slot]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word of each) after all merges; `word` ascends, and symbols below zero never merge."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, merged = np.full(len(symbols), _NEVER, dtype=np.int32), np.zeros(len(symbols), dtype=np.int64)
        changed = np.flatnonzero(word[1:] == word[:-1])
        while len(symbols):
            rank[changed], merged[changed] = self._merge_of(symbols[changed], symbols[changed + 1])
            begins = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(begins, len(word)))
            best = np.minimum.reduceat(rank, begins)
            least = np.repeat(best, size)
            chosen = np.flatnonzero((rank == least) & (least < _NEVER))
            # of neighbours that share a symbol, every other one from the left
            head = np.concatenate(([True], np.diff(chosen) != 1))[: len(chosen)]
            chosen = chosen[(np.arange(len(chosen)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 0]
            disordered = self._disordered(symbols, word, merged, least, chosen)
            leave = np.repeat(best == _NEVER, size)
            done.append((symbols[leave], word[leave]))
            if disordered.any():
                for w in np.unique(word[chosen[disordered]]).tolist():
                    i, j = np.searchsorted(word, [w, w + 1])
                    steps = self._steps(symbols[i:j].tolist())
                    done.append((np.array(steps, dtype=np.int64), np.full(len(steps), w)))
                    leave[i:j] = True
                chosen = chosen[~leave[chosen]]
            symbols[chosen] = merged[chosen]
            rank[chosen] = _NEVER
            stays = ~leave
            stays[chosen + 1] = False
            place = np.cumsum(stays)[chosen] - 1
            symbols, word, rank, merged = symbols[stays], word[stays], rank[stays], merged[stays]
            near = np.zeros(len(word) + 1, dtype=bool)  # the last is that of a pair before the first symbol
            near[place] = near[place - 1] = True
            changed = np.flatnonzero(near[: len(word) - 1] & (word[1:] == word[:-1])) if len(word) else place
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (symbols, word)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _disordered(self, symbols: np.ndarray, word: np.ndarray, merged: np.ndarray, least: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Whether a merge at each of the places `chosen` makes a pair of its own rank or a better one, which goes first."""
        new = merged[chosen]
        # to the left stands what this round has made there, to the right what has not been merged yet
        before = np.where(chosen > 0, symbols[np.maximum(chosen - 1, 0)], -1)
        joined = np.flatnonzero(np.diff(chosen) == 2) + 1
        before[joined] = new[joined - 1]
        before[(chosen == 0) | (word[np.maximum(chosen - 1, 0)] != word[chosen])] = -1
        behind = np.minimum(chosen + 2, len(symbols) - 1)
        after = np.where((chosen + 2 < len(symbols)) & (word[behind] == word[chosen]), symbols[behind], -1)
        return np.minimum(self._merge_of(before, new)[0], self._merge_of(new, after)[0]) <= least[chosen]

    def _steps(self, symbols: list[int]) -> list[int]:
        """The merges of one word one by one, the best rank first, of equal ones the leftmost."""
        n = len(symbols)
        before, behind = list(range(-1, n - 1)), [*range(1, n), -1]

        def pairs(at: list[int]) -> list[tuple[int, int, int, int, int]]:
            left = [symbols[i] for i in at]
            right = [symbols[behind[i]] for i in at]
            rank, merged = self._merge_of(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64))
            found = zip(rank.tolist(), at, left, right, merged.tolist(), strict=True)
            return [x for x in found if x[0] < _NEVER]

        heap = pairs(list(range(n - 1)))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = behind[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # one of them has been merged since
            symbols[i], symbols[j] = merged, -1
            behind[i] = behind[j]
            if behind[j] >= 0:
                before[behind[j]] = i
            near = [k for k in (before[i], i) if k >= 0 and behind[k] >= 0]
            for pair in pairs(near) if near else ():
                heapq.heappush(heap, pair)
        out, i = [], 0
        while i >= 0:
            out.append(symbols[i])
            i = behind[i]
        return out

    def _encode_words(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids) of words, which begin with a space where one precedes them."""
        texts = pc.cast(found, pa.large_string())
        ends = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset : found.offset + len(found) + 1]
        whole = found.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().decode()
        points = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        word = np.repeat(np.arange(len(found)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
        points[points == 32] = ord(SPACE)
        # parts of a word between which no piece reaches are merged on their own
        beside = points[:-1] << 32 | points[1:]
        known = np.minimum(np.searchsorted(self.reach, beside), len(self.reach) - 1)
        joins = (self.reach[known] == beside) & (word[1:] == word[:-1])
        part = np.concatenate(([0], np.cumsum(~joins)))
        at = np.minimum(np.searchsorted(self.char, points), len(self.char) - 1)
        symbols = np.where(self.char[at] == points, self.char_id[at], -1 - points)
        symbols, part_of = self.merge(symbols, part)
        word = word[np.searchsorted(part, part_of)]
        unknown = np.flatnonzero(symbols < 0)
        if len(unknown):  # a character without a piece is its bytes
            raw = [chr(c).encode() for c in (-1 - symbols[unknown]).tolist()]
            count = np.ones(len(symbols), dtype=np.int64)
            count[unknown] = [len(r) for r in raw]
            first = np.cumsum(count) - count
            symbols, word = np.repeat(symbols, count), np.repeat(word, count)
            places = np.repeat(first[unknown] - np.cumsum(count[unknown]) + count[unknown], count[unknown])
            symbols[places + np.arange(len(places))] = self.of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return np.bincount(word, minlength=len(found)).astype(np.int64), symbols.astype(np.int32)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Words of each text, a space set before it: their number per text, and all of them."""
        texts = pc.cast(pc.replace_substring(pc.fill_null(texts, ""), SPACE, " "), pa.large_binary())
        full = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        spaced = pc.binary_join_element_wise(pa.scalar(b"", pa.large_binary()), texts, pa.scalar(b" ", pa.large_binary()))
        size = np.where(full, pc.binary_length(spaced).to_numpy(zero_copy_only=False), 0).astype(np.int64)
        data = b"".join(pc.if_else(pa.array(full), spaced, pa.scalar(b"", pa.large_binary())).to_pylist())
        raw = np.frombuffer(data, dtype=np.uint8)
        begins = np.zeros(len(raw), dtype=bool)
        if len(raw):
            begins[1:] = self.alone[raw[1:]] | self.alone[raw[:-1]]
            if self.cut_at_space:
                begins[1:] |= (raw[1:] == 32) & (raw[:-1] != 32)
            begins[(np.cumsum(size) - size)[full]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        text_of = np.searchsorted(np.cumsum(size), starts, side="right")
        return np.bincount(text_of, minlength=len(texts)).astype(np.int64), found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids)."""
        per, found = self._words(texts)
        coded = found.dictionary_encode()
        size, begins, flat = self.known.look_up(coded.dictionary, self._encode_words, MEMORY)
        index = coded.indices.to_numpy(zero_copy_only=False)
        each = size[index]
        row = np.repeat(np.arange(len(per)), per)
        return np.bincount(row, weights=each, minlength=len(per)).astype(np.int64), flat[words.stretches(begins[index], each)]

    def decode_all(self, lists: pa.Array) -> pa.Array:
        """The texts of lists of ids."""
        lists = pc.fill_null(lists, [])
        ids = lists.flatten()
        silent = pc.any(pc.is_in(ids, value_set=pa.array(sorted(self.silent), pa.int32()))).as_py()
        ends = np.append(0, np.cumsum(np.diff(np.asarray(lists.offsets))))
        places = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        places[ends[:-1][np.diff(ends) > 0]] += self.size
        surfaces = self.surfaces.take(pa.array(places))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), surfaces), b"")
        try:
            if not silent:
                return pc.cast(texts, pa.string())
        except pa.ArrowInvalid:
            pass  # bytes that are no character
        return pa.array([self.decode(x) for x in lists.to_pylist()], pa.string())

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the first piece with a surface loses one space, bytes that are no character become U+FFFD."""
        if self.silent.isdisjoint(ids):
            parts = [ids]
        else:  # bytes on both sides of a piece without a surface are not one character
            parts = [list(part) for silent, part in groupby(ids, self.silent.__contains__) if not silent]
        raw = [b"".join([self.surface[i] for i in part]) for part in parts]
        if parts and parts[0] and parts[0][0] in self.spaced:
            raw[0] = raw[0][1:]
        return "".join([r.decode("utf-8", "llm.one_by_one") for r in raw])


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    """One a worker."""
    return Pieces(path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in words.slices(batch["text"]):
            per, ids = _pieces(path).encode(texts)
            offsets = pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32())
            columns = [batch["doc_id"].slice(first, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), DECODED):
            own = batch.slice(first, DECODED)
            yield pa.RecordBatch.from_arrays([own["doc_id"], own["ids"], _pieces(path).decode_all(own["ids"])], names=["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of docs(doc_id, text), with the SentencePiece BPE model at `path`.

    No begin or end ids. A null or empty text has no ids. Rows are encoded one by one, so null and repeated ids of
    documents are as any others; other columns are left aside; an empty table gives no rows.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _encoded(batches, path), "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of rows(doc_id, ids); null ids are the empty text."""
    return rows.select("doc_id", "ids").mapInArrow(lambda batches: _decoded(batches, path), "doc_id long, ids array<int>, decoded string")


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(encode(table(spark, sf_dir, "documents"), model_path()), model_path())
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_hex(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )
