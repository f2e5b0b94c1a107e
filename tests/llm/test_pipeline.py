import corpus
import corpus_pipeline
import numpy as np

from llm.spark import table


def test_stages_one_by_one(spark):
    """Each stage against the plain version of its operator, on what the stage before it kept."""
    from test_decontamination import MAX_EDITS, plain_words
    from test_token_output import expected

    docs = table(spark, corpus.SF, "documents")
    columns, seen = docs.columns, {}
    items = [plain_words(r.text) for r in table(spark, corpus.SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, corpus.SF).cache()
        rows = docs.collect()
        assert docs.columns == columns
        kept = {r.doc_id for r in rows}
        if name == "language":
            assert {i for i, t in before.items() if t and any(c.isalpha() for c in t)} - kept == set()
        if name == "near_duplicates":
            groups = corpus.plain_components(list(before.items()))
            assert kept == {i for i, (_, c) in groups.items() if i == c} and len(rows) == len(kept)
        if name == "decontamination":
            own = {i: plain_words(t) for i, t in before.items()}
            leaked = {i for i, w in own.items() for item in items if len(set(w) & set(item)) * 2 >= len(set(item)) and corpus.best_infix(item, w) <= MAX_EDITS * len(item)}
            assert kept == before.keys() - leaked
        seen[name] = len(rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, corpus.SF).collect()
    assert len(last) == seen["mixing"]
    once = {r.doc_id: r.text for r in docs.collect()}
    plain = expected(list(once.items()))
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in last} == {(i, n, c) for i, (_, n, c) in plain.items()}
    ends = np.cumsum([r.n_tokens for r in sorted(last, key=lambda r: r.start)])
    assert [r.start for r in sorted(last, key=lambda r: r.start)] == [0, *ends[:-1].tolist()]


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, corpus.SF).collect()
    assert rows and [*rows[0].asDict()] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None
