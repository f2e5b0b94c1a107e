import math
import re
import zlib
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
import pytest

from llm.language_id import UNKNOWN, build, entropies, identify, keep_identified, op10_language_id, predict, train


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op10_language_id(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)


def grams(texts_by_lang, order):
    from llm.language_id import _count

    batches = [pa.RecordBatch.from_arrays([pa.array(t), pa.array([k] * len(t))], names=["text", "lang"]) for k, t in texts_by_lang.items()]
    table = pa.Table.from_batches(list(_count(iter(batches), order)))
    return table.group_by(["lang", "n", "gram"]).aggregate([("history", "min"), ("suffix", "min"), ("initial", "min"), ("c", "sum")]).rename_columns(["lang", "n", "gram", "history", "suffix", "initial", "c"])


class PlainKneserNey:
    """Interpolated Kneser-Ney over letters inside words, with dictionaries; `_` is a word's end."""

    def __init__(self, texts, order, alphabet):
        self.order, self.floor = order, 1 / (alphabet + 1)
        counts = [Counter() for _ in range(order + 1)]
        for text in texts:
            for run in self.runs(text):
                for i in range(1, len(run)):
                    for n in range(1, min(order, i + 1) + 1):
                        counts[n][run[i + 1 - n : i + 1]] += 1
        self.counts = []
        for n in range(1, order + 1):
            own = dict(counts[n])
            if n < order:
                before = Counter(gram[1:] for gram in counts[n + 1])
                for gram in own:
                    if not gram.startswith("_") or gram == "_":  # a longer history may precede it
                        own[gram] = before.get(gram, own[gram])
            self.counts.append(own)
        self.discounts, self.totals, self.kinds = [], [], []
        for own in self.counts:
            n1, n2 = (sum(c == k for c in own.values()) for k in (1, 2))
            self.discounts.append(n1 / (n1 + 2 * n2) if n1 and n2 else 0.5)
            total, kinds = Counter(), Counter()
            for gram, c in own.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            self.totals.append(total)
            self.kinds.append(kinds)

    @staticmethod
    def runs(text):
        for word in corpus.words(text):
            for run in re.findall(r"[^\W\d_]+", word.lower()):
                yield f"_{run}_"

    def probability(self, history, symbol):
        p = self.floor
        for n in range(1, min(self.order, len(history) + 1) + 1):
            own = history[len(history) + 1 - n :]
            total = self.totals[n - 1][own]
            if total:
                c = self.counts[n - 1].get(own + symbol, 0)
                d = self.discounts[n - 1]
                p = (max(c - d, 0) + d * self.kinds[n - 1][own] * p) / total
        return p

    def entropy(self, text):
        logs = [-math.log(self.probability(run[:i], run[i])) for run in self.runs(text) for i in range(1, len(run))]
        return sum(logs) / len(logs) if logs else 0.0


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_entropies_are_those_of_a_plain_model(spark, order):
    docs = [r for r in spark.read.parquet(f"{corpus.SF}/documents.parquet").collect() if len(r.text) < 6000]
    langs = sorted({r.lang for r in docs})
    fitted = {k: [r.text for r in docs if r.lang == k][:12] for k in langs}
    model = build(grams(fitted, order), langs, order)
    alphabet = {c for k in langs for t in fitted[k] for run in PlainKneserNey.runs(t) for c in run}
    assert model.alphabet == len(alphabet)
    texts = [r.text for r in docs[-25:]] + ["Zebra zzyzx", "a", "über naïve", "12 !", "x-y z1a"]
    found, _ = entropies(model, pa.array(texts))
    for j, k in enumerate(langs):
        plain = PlainKneserNey(fitted[k], order, len(alphabet))
        assert found[:, j] == pytest.approx([plain.entropy(t) for t in texts], rel=1e-4, abs=1e-6)


def test_probabilities_of_a_history_sum_to_one():
    """Over every symbol of both languages, for histories seen and unseen."""
    texts = {"x": ["abc abd abe bab cab", "abba"], "y": ["bcd ddd dcb"]}
    model = build(grams(texts, 3), ["x", "y"], 3)
    symbols = sorted({c for t in texts.values() for s in t for c in s if c != " "})
    for history in ("", "a", "ab", "dd", "c"):
        total = np.zeros(2)
        for c in symbols:
            # the word with one more symbol, less the word itself: both end at a boundary, so it is left out by hand
            total += np.exp(_last(model, history + c))
        total += np.exp(_last(model, history + " ")) if history else 0
        # without a history no boundary can follow; what is left is the mass of symbols never seen
        assert (total <= 1 + 1e-5).all() and (total > (0.5 if history else 0.3)).all()


def _last(model, text):
    """Log probability by language of the last symbol of `text` after those before it."""
    from llm import language_id as m

    s = m._symbols(pa.array([text.strip() + ("" if text.endswith(" ") else "")]))
    at = len(text)  # a boundary comes first
    one = np.zeros(len(s.scored), dtype=bool)
    one[at] = True
    s.scored = s.scored & one
    return m._log_probabilities(model, s)[0][0]


def test_rejects_what_is_unlike_all_languages(spark):
    model = train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = ["qxzj wvkq xzqj jkqx " * 30, "12 !!", None, "", "the and of that is in the"]
    found = predict(model, pa.array(texts))
    assert found["rejected"].tolist() == [True, True, True, True, False]
    assert found["lang_pred"].tolist()[1:4] == [UNKNOWN] * 3 and found["lang_pred"][4] == "en"
    h, n = entropies(model, pa.array(["The Of", "the of"]))
    assert (h[0] == h[1]).all() and n.tolist() == [7, 7]


def test_mislabelled_rows_do_not_open_the_limits(spark):
    """One row in fifty has another language's label; a language in learned letters that was not learned is still let go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "n_chars")
    known = docs.where("lang <> 'es'")
    wrong = known.selectExpr("doc_id", "text", "if(pmod(hash(doc_id), 50) = 0, if(lang = 'en', 'fr', 'en'), lang) as lang")
    clean, noisy = train(known), train(wrong)
    assert noisy.limits == pytest.approx(clean.limits, rel=0.25)
    for model in (clean, noisy):
        rows = {r.doc_id: r.rejected for r in identify(docs, model).collect()}
        lang = {r.doc_id: r.lang for r in docs.collect()}
        unlearned = [rejected for i, rejected in rows.items() if lang[i] == "es"]
        learned = [rejected for i, rejected in rows.items() if lang[i] != "es"]
        assert sum(unlearned) > 0.9 * len(unlearned) and sum(learned) < 0.01 * len(learned)


def test_rows_without_an_id_are_not_held_out(spark, monkeypatch):
    from llm import language_id

    docs = spark.createDataFrame([(None, "the cat", "en"), (1, "the dog", "en")], "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "table", lambda *_: docs)
    rows = op10_language_id(spark, "").collect()
    assert {r.doc_id: r.held_out for r in rows} == {None: False, 1: zlib.crc32(b"1") % 3 == 1}


def test_edges(spark):
    docs = corpus.edge_docs(spark)
    for model in (train(docs), train(corpus.no_docs(spark)), train(docs.where("false"))):
        rows = identify(docs, model).collect()
        assert len(rows) == len(corpus.edge_rows())
        for r in rows:
            assert r.lang_pred in [*model.langs, UNKNOWN]
            if r.doc_id in (1, 2, 3, 11):
                assert (r.lang_pred, r.score, r.rejected) == (UNKNOWN, 0.0, True)
        assert keep_identified(docs, model).columns == docs.columns
        assert keep_identified(docs, model).count() == sum(not r.rejected for r in rows)
        assert identify(corpus.no_docs(spark), model).collect() == []


def test_every_n_gram_of_the_sample_stays_whatever_other_languages_hold(spark):
    rng = np.random.default_rng(4)
    draw = lambda first, n, size: ["".join(map(chr, first + x)) for x in rng.integers(0, 26, (n, size))]
    large = draw(97, 150_000, 20)
    rare = draw(0x430, 40, 9)  # no run of five letters twice
    rows = [(i, " ".join(large[i::300]), f"l{i % 3}") for i in range(300)] + [(i, rare[i - 300], "rare") for i in range(300, 340)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    by = {lang: [len(g) for g in own.grams] for lang, own in zip(model.langs, model.fitted, strict=True)}
    assert sum(map(sum, by.values())) > 1_500_000
    counted = by["rare"][4] // 7  # nine letters between two boundaries have seven runs of five
    assert counted >= 10 and by["rare"][4] == 7 * counted
    assert predict(model, pa.array(rare))["lang_pred"].tolist() == ["rare"] * len(rare)
