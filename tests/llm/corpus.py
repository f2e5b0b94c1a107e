"""Small tables and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, places string, range int, size string,"
    " draw int, rep int, bands int, kept string, component string, bucket int, line int, words int, codes int, ids int"
)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def edge_rows() -> list[tuple]:
    """Nulls in any column, empty and blank texts, a long text, ties, repeated rows."""
    rng = random.Random(4)
    long_ = " ".join(rng.choice(["ab", "c,d", "é", "\n", "zz", "The", "q%d" % rng.randrange(9999)]) for _ in range(60_000))
    passage = " ".join(f"w{i}" for i in range(40))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, long_), (5, "one two"), (6, "one two"), (6, "one two"), (7, "One  two\x0bthree"),
        (8, f"start {passage} end"), (9, f"{passage}\n{passage}"), (None, "no id here at all"), (None, None), (10, f"x {passage}"),
        (11, "12 34 !!"), (-5, f"before {passage}"), (12, long_ + " tail"), (2**62, "far away"),
    ]
    langs, sources = ["en", None, "fr"], ["b", None, "a", "ß"]
    return [
        (i, t, langs[k % 3], sources[k % 4], None if t is None else len(t), *[None if k % 2 else v for v in (k, "p", k, "s", k, k, k, "k", "c", k, k, k, k, k)])
        for k, (i, t) in enumerate(texts)
    ]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_window_dedup(docs: list[tuple], window: int = 20) -> dict:
    """doc_id -> (n_words, n_removed, kept), of (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            run = tuple(own[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        out[doc_id] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g))
    return out


def odd_ids(spark):
    """Rows that share an id or have none, also the smallest id there is, and repeat each other's texts."""
    passage, other = " ".join(f"r{i}" for i in range(30)), " ".join(f"s{i}" for i in range(40))
    rows = [
        (1, f"{passage} first"), (2, f"{passage} second"), (2, other), (3, "v " * 25), (3, "v " * 25), (4, "x y z\np q"), (5, "p q r\nx y z"),
        (5, "x y z\nx y z w v"), (None, other), (None, other), (None, f"{other} and on"), (None, passage), (None, None), (None, ""),
        (-(2**63), other), (-(2**63), "x y z"), (2**63 - 1, f"{passage} first"), (6, "a b c d e f"), (6, "a b c d e f"), (6, "nothing alike at all here"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def ranked(docs) -> list[tuple]:
    """(key, doc_id, text) of every row, keys in the order of doc_id, nulls first, and of a hash of the text."""
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    return [(k, r.doc_id, r.text) for k, r in enumerate(rows)]


def shingles(text: str | None) -> set:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    own = words(low)
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else ({tuple(own)} if own else set())


def plain_components(docs: list[tuple]) -> dict:
    """doc_id -> (n_shingles, component), of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edit_distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best_infix(item: list, text: list) -> int:
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
