"""Language identification with interpolated Kneser-Ney character models.

Each language has a character model of order ORDER inside words; a word's ends count as a boundary symbol and no history
crosses it. Counts come from a bounded sample of labelled rows, and every n-gram of it is in the model, which so grows
with the sample and with nothing else. Each language has its own sorted hash arrays, with the log probabilities of its
n-grams and the log back-off weights of its histories.
A text gets the language of the lowest cross-entropy per symbol; it is rejected if that entropy lies above what texts of
the language have, as measured on sampled rows left out of the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import table, written

ORDER = 5
#: Expected rows that a language gives to the sample; one in five of them calibrates.
SAMPLE_DOCS = 2000
#: Share of a language's own texts that calibration lets go, and the leeway for short texts, in nats over sqrt(symbols).
FALSE_REJECT, LEEWAY = 0.001, 4.0
UNKNOWN = "und"
_SPACE = 32
#: How the arrays of a fitted language come back from its task.
_ARRAYS = {"grams": np.uint64, "logp": np.float32, "histories": np.uint64, "backoff": np.float32}


@dataclass
class _Language:
    """The model of one language, by order - 1."""

    grams: list[np.ndarray] = field(default_factory=list)  # sorted hashes
    logp: list[np.ndarray] = field(default_factory=list)
    histories: list[np.ndarray] = field(default_factory=list)  # sorted hashes
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0  # log probability of a symbol never seen


@dataclass
class Model:
    langs: list[str]
    fitted: list[_Language] = field(default_factory=list)  # by language
    alphabet: int = 0  # distinct symbols of all languages
    order: int = ORDER
    limits: np.ndarray | None = None  # entropy beyond which a text is rejected
    sharpness: float = 20.0


@dataclass
class _Symbols:
    """The distinct words of some texts as one run of symbols."""

    per: np.ndarray  # words of each text
    index: np.ndarray  # of each word, its distinct word
    code: np.ndarray  # symbols; all but letters are _SPACE
    owner: np.ndarray  # of each symbol, its distinct word
    scored: np.ndarray  # symbols that are predicted: letters, and the first boundary after one
    depth: np.ndarray  # symbols from the last boundary on, up to and with this one


def _symbols(texts: pa.Array) -> _Symbols:
    per, flat = words.split_words(texts)
    coded = flat.dictionary_encode()
    distinct = pc.utf8_lower(coded.dictionary)
    joined = " " + "".join(f"{w} " for w in distinct.to_pylist())
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds, kind = np.unique(code, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in kinds], dtype=bool)[kind]
    owner = np.repeat(np.arange(len(distinct)), pc.utf8_length(distinct).to_numpy(zero_copy_only=False) + 1)
    owner = np.concatenate(([0], owner)).astype(np.int64)
    code = np.where(letter, code, _SPACE).astype(np.uint64)
    scored = letter.copy()
    scored[1:] |= letter[:-1]
    at = np.arange(len(code))
    # the boundary before a symbol; a boundary symbol looks at the one before it
    last = np.maximum.accumulate(np.where(letter, 0, at))
    last = np.concatenate(([0], last[:-1]))
    return _Symbols(per, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), code, owner, scored, at - last + 1)


def _hashes(code: np.ndarray, order: int) -> np.ndarray:
    """Hash of the `order` symbols that end at each place (0 where there are fewer)."""
    out = np.zeros(len(code), dtype=np.uint64)
    runs = words.run_hashes(words.mix(code + np.uint64(1)), order)
    out[order - 1 :] = runs if len(code) >= order else 0
    return out


def _count(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(lang, n, gram, history, suffix, initial, c): the n-grams of each language in a batch."""
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = batch["text"].filter(pc.equal(langs.indices, k))
            for _, texts in words.slices(own):
                s = _symbols(texts)
                if not len(s.index):
                    continue
                weight = np.bincount(s.index, minlength=int(s.owner.max()) + 1)
                by = [_hashes(s.code, n) if n else np.zeros(len(s.code), np.uint64) for n in range(order + 1)]
                for n in range(1, order + 1):
                    at = np.flatnonzero(s.scored & (s.depth >= n))
                    gram, first, inverse = np.unique(by[n][at], return_index=True, return_inverse=True)
                    at_first = at[first]
                    counts = np.bincount(inverse, weights=weight[s.owner[at]], minlength=len(gram)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(gram), pa.string()),
                            pa.array(np.full(len(gram), n, np.int32)),
                            pa.array(gram.view(np.int64)),
                            pa.array(by[n - 1][at_first - 1].view(np.int64)),
                            pa.array(by[n - 1][at_first].view(np.int64)),
                            pa.array(s.depth[at_first] == n),
                            pa.array(counts),
                        ],
                        names=["lang", "n", "gram", "history", "suffix", "initial", "c"],
                    )


def _find(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of `keys` in sorted `hashes`; -1 where they are not."""
    if not len(hashes):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where(hashes[at] == keys, at, -1)


def _fit(grams: pa.Table, alphabet: int, order: int) -> _Language:
    """The model of one language's (n, gram, history, suffix, initial, c)."""
    model = _Language(floor=-np.log(alphabet + 1.0))
    n = grams["n"].to_numpy()
    u64 = lambda name: grams[name].to_numpy().view(np.uint64)
    gram, history, suffix = u64("gram"), u64("history"), u64("suffix")
    initial, c = grams["initial"].to_numpy(), grams["c"].to_numpy().astype(np.float64)
    for k in range(1, order + 1):
        own = np.flatnonzero(n == k)
        own = own[np.argsort(gram[own])]
        e = c[own].copy()
        if k < order:
            kinds, times = np.unique(suffix[n == k + 1], return_counts=True)
            at = _find(kinds, gram[own])
            follows = ~initial[own] & (at >= 0)
            e[follows] = times[at[follows]]
        past, where = np.unique(history[own], return_inverse=True) if k > 1 else (np.zeros(1, np.uint64), np.zeros(len(own), int))
        n1, n2 = (e == 1).sum(), (e == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total = np.bincount(where, weights=e, minlength=len(past))
        weight = np.zeros(len(past))  # log 1: nothing seen
        seen = total > 0
        weight[seen] = np.log(discount * np.bincount(where, minlength=len(past))[seen] / total[seen])
        if k == 1:
            below = np.full(len(own), model.floor)
            model.floor += weight[0]
        else:
            at = _find(model.grams[-1], suffix[own])
            below = np.full(len(own), model.floor)
            below[at >= 0] = model.logp[-1][at[at >= 0]]
        logp = np.logaddexp(np.log((e - discount) / total[where]), weight[where] + below)
        model.grams.append(gram[own])
        model.logp.append(logp.astype(np.float32))
        model.histories.append(past)
        model.backoff.append(weight.astype(np.float32))
    return model


def build(grams: pa.Table, langs: list[str], order: int = ORDER) -> Model:
    """The models of (lang, n, gram, history, suffix, initial, c)."""
    alphabet = len(pc.unique(grams["gram"].filter(pc.equal(grams["n"], 1))))
    return Model(langs, [_fit(grams.filter(pc.equal(grams["lang"], k)), alphabet, order) for k in langs], alphabet, order)


def _log_probabilities(model: Model, s: _Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word: log probability by language, and predicted symbols."""
    at = np.flatnonzero(s.scored)
    depth = np.minimum(s.depth[at], model.order)
    hashes = [_hashes(s.code, k) for k in range(1, model.order + 1)]
    n = int(s.owner.max()) + 1 if len(s.owner) else 0
    sums = np.zeros((n, len(model.langs)))
    for j, own in enumerate(model.fitted):
        out = np.zeros(len(at), dtype=np.float32)
        open_ = np.arange(len(at))
        for k in range(model.order, 0, -1):
            if k < model.order:  # not found one order higher: the weight of that history
                rows = open_[depth[open_] > k]
                where = _find(own.histories[k], hashes[k - 1][at[rows] - 1])
                out[rows[where >= 0]] += own.backoff[k][where[where >= 0]]
            deep = depth[open_] >= k
            rows = open_[deep]
            where = _find(own.grams[k - 1], hashes[k - 1][at[rows]])
            out[rows[where >= 0]] += own.logp[k - 1][where[where >= 0]]
            deep[deep] = where >= 0
            open_ = open_[~deep]
        out[open_] += np.float32(own.floor)
        sums[:, j] = np.bincount(s.owner[at], weights=out, minlength=n)
    return sums, np.bincount(s.owner[at], minlength=n)


def entropies(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy in nats a symbol by language, predicted symbols) of each text; no symbols: entropy 0."""
    h, n = [np.zeros((0, len(model.langs)))], [np.zeros(0, np.int64)]
    for _, part in words.slices(texts):
        s = _symbols(part)
        sums, symbols = _log_probabilities(model, s)
        row = np.repeat(np.arange(len(s.per)), s.per)
        total = np.bincount(row, weights=symbols[s.index], minlength=len(s.per)).astype(np.int64)
        by = [np.bincount(row, weights=sums[s.index, j], minlength=len(s.per)) for j in range(len(model.langs))]
        h.append(-np.stack(by, axis=1) / np.maximum(total, 1)[:, None])
        n.append(total)
    return np.concatenate(h), np.concatenate(n)


def predict(model: Model, texts: pa.Array) -> dict[str, np.ndarray]:
    """lang_pred, score, entropy and rejected of each text."""
    if not len(model.langs):
        none = np.zeros(len(texts))
        return {"lang_pred": np.full(len(texts), UNKNOWN, object), "score": none, "entropy": none, "rejected": none == 0}
    h, n = entropies(model, texts)
    known = n > 0
    best = h.argmin(axis=1)
    low = h.min(axis=1)
    score = 1 / np.exp(np.maximum(model.sharpness * (low[:, None] - h), -700)).sum(axis=1)
    over = low > model.limits[best] + LEEWAY / np.sqrt(np.maximum(n, 1))
    return {
        "lang_pred": np.where(known, np.array(model.langs, dtype=object)[best], UNKNOWN),
        "score": np.where(known, score, 0.0),
        "entropy": np.where(known, low, 0.0),
        "rejected": ~known | over,
    }


def _held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, order: int = ORDER) -> Model:
    """Fit on docs(doc_id, text, lang) outside the held-out fold (crc32 of doc_id as text, modulo 3, is 1).

    Rows without a label, or in the held-out fold, or with a null doc_id give nothing. Of the others about `sample_docs`
    a language are taken by a hash of doc_id.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~_held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return Model([])
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample_docs / sizes[k]))])
    draw = (F.xxhash64("doc_id", F.lit("sample")) % 1_000_000 + 1_000_000) % 1_000_000 / 1_000_000
    taken = rows.where(draw < share[F.col("lang")])
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5)) == 0
    grams = written(
        taken.where(~calibrates)
        .select("text", "lang")
        .mapInArrow(
            lambda b: _count(b, order),
            "lang string, n int, gram long, history long, suffix long, initial boolean, c long",
        )
        .groupBy("lang", "n", "gram")
        .agg(F.min("history").alias("history"), F.min("suffix").alias("suffix"), F.min("initial").alias("initial"), F.sum("c").alias("c")),
        "grams",
    )
    alphabet = grams.where("n = 1").agg(F.count_distinct("gram")).first()[0]

    def fit(group: pa.Table) -> pa.Table:
        own = _fit(group, alphabet, order)
        by_order = zip(own.grams, own.logp, own.histories, own.backoff, strict=True)
        return pa.Table.from_pylist(
            [
                {"lang": group["lang"][0].as_py(), "n": k, "floor": float(own.floor), **{name: x.tobytes() for name, x in zip(_ARRAYS, found, strict=True)}}
                for k, found in enumerate(by_order)
            ],
            pa.schema([("lang", pa.string()), ("n", pa.int32()), ("floor", pa.float64()), *((name, pa.binary()) for name in _ARRAYS)]),
        )

    # a language's part of the sample is one task; what comes back is the model alone
    schema = "lang string, n int, floor double, " + ", ".join(f"{name} binary" for name in _ARRAYS)
    model = Model(langs, [], alphabet, order)
    found = {(r["lang"], r["n"]): r for r in grams.groupBy("lang").applyInArrow(fit, schema).collect()}
    none = pa.table({k: pa.array([], t) for k, t in (("n", pa.int32()), *((k, pa.int64()) for k in ("gram", "history", "suffix", "c")), ("initial", pa.bool_()))})
    for lang in langs:
        if (lang, 0) not in found:  # no letter in its rows
            model.fitted.append(_fit(none, alphabet, order))
            continue
        own = _Language(floor=found[lang, 0]["floor"])
        for k in range(order):
            for name, kind in _ARRAYS.items():
                getattr(own, name).append(np.frombuffer(found[lang, k][name], dtype=kind))
        model.fitted.append(own)
    model.limits = np.full(len(langs), np.inf)

    def measure(batches):
        for batch in batches:
            h, n = entropies(model, batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], pa.array(list(h), pa.list_(pa.float64())), pa.array(n)], names=["lang", "h", "n"]
            )

    seen = taken.where(calibrates).select("text", "lang").mapInArrow(measure, "lang string, h array<double>, n long")
    _calibrate(model, [r for r in seen.collect() if r["n"]])  # at most a fifth of the sample
    return model


def _calibrate(model: Model, rows: list) -> None:
    """Limits of entropy by language, and the sharpness under which scores fit the labels best."""
    if not rows:
        return
    h, n = np.array([r["h"] for r in rows]), np.array([r["n"] for r in rows])
    label = np.array([model.langs.index(r["lang"]) for r in rows])
    own = h[np.arange(len(h)), label] - LEEWAY / np.sqrt(n)
    right = h.argmin(axis=1) == label  # rows that read as another language say nothing of their label's
    for j in range(len(model.langs)):
        mine = own[right & (label == j)]
        if len(mine) < 20:  # too few rows: those of all languages
            mine = own[right] if right.any() else own
        high, middle = np.quantile(mine, 1 - FALSE_REJECT), np.median(mine)
        # never below halfway from the median to an even draw of symbols
        model.limits[j] = max(2 * high - middle, (middle + np.log(model.alphabet + 1)) / 2)
    best = -np.inf
    for s in (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0):
        z = -s * (h - h.min(axis=1, keepdims=True))
        fit = (z[np.arange(len(h)), label] - np.log(np.exp(z).sum(axis=1))).mean()
        if fit > best + 1e-9:
            best, model.sharpness = fit, s


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) of every row of docs(doc_id, text).

    `und` with score 0 where a text is null or has no letter, or where no language was learned. Among equal entropies
    the first language by code point is taken. Rows that repeat give one row each; other columns are left aside.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        for batch in batches:
            found = predict(shared.value, batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found["lang_pred"], pa.string()), *(pa.array(found[k]) for k in ("score", "entropy", "rejected"))],
                names=["doc_id", *found],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs(text, ...) whose language is found and not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array(~predict(shared.value, batch.column(at))["rejected"]))
        words.give_back()

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    # a null doc_id is in no fold, and its row is not learned from either
    held_out = F.coalesce(_held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")
