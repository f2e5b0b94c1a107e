import compare
import corpus
import pytest

from llm import line_dedup
from llm.line_dedup import dedup_lines, op4_line_dedup


def plain(docs, percent):
    seen, out = [], {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        lines, kept = [] if text is None else text.split("\n"), []
        for line in lines:
            own = set(corpus.words(line))
            if not own or not any(100 * len(own & s) >= percent * len(own | s) for s in seen):
                kept.append(line)
            if own:
                seen.append(own)
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_query_equals_sql(spark):
    assert compare.difference(op4_line_dedup(spark, corpus.SF), compare.connect(corpus.SF), line_dedup.SQL) == ""


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_near_lines_equal_brute_force(spark, percent):
    import random

    rng = random.Random(percent)
    base = [[rng.choice("abcdefghijklm") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 14))] for _ in range(30)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(4)):
            own = [w if rng.random() > 0.1 else rng.choice("xyz") for w in rng.choice(base)]
            lines.append(" ".join(own))
        docs.append((i, "\n".join(lines)))
    found = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), percent).collect()}
    assert found == plain(docs, percent)


def test_long_near_lines_and_any_white_space_equal_brute_force(spark):
    import random

    rng = random.Random(7)
    base = [[f"{rng.choice('abcd')}{rng.randrange(5000)}" for _ in range(rng.choice([90, 96, 97, 100, 120, 250]))] for _ in range(8)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(3):
            share = rng.choice([0.05, 0.09, 0.1, 0.11, 0.13])
            own = [w if rng.random() > share else f"x{rng.randrange(5000)}" for w in rng.choice(base)]
            space = rng.choice([" ", "  ", "\t", " \r", "\x0b \x0c"])
            lines.append(space + space.join(own) + space)
        docs.append((i, "\n".join(lines)))
    found = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == plain(docs, 80)
    assert 20 < sum(r[1] for r in found.values()) < 170


def test_steps_that_are_written_leave_no_shuffles(spark, tmp_path):
    import random
    import time
    from pathlib import Path

    def lying() -> dict:
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f: f.stat().st_size for d in folders for f in Path(d.getPath()).glob("*/shuffle_*.data")}

    rng = random.Random(2)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(300)}" for _ in range(30)) for _ in range(20))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    before = set(lying())
    found = dedup_lines(spark.read.parquet(f"{tmp_path}/docs"))
    limit = sum(len(t) for _, t in rows) / 10
    for _ in range(50):  # they go in the background
        left = sum(v for f, v in lying().items() if f not in before)
        if left < limit:
            break
        time.sleep(0.1)
    assert left < limit
    assert found.count() == len(rows)


def test_edges(spark):
    for docs in (corpus.edge_docs(spark), corpus.odd_ids(spark)):
        rows = corpus.ranked(docs)
        kept = plain({(k, t) for k, _, t in rows}, 80)
        expected = sorted(((i, *kept[k]) for k, i, _ in rows), key=str)
        assert sorted(map(tuple, dedup_lines(docs).collect()), key=str) == expected
    assert dedup_lines(corpus.no_docs(spark)).collect() == []


def test_main_path_has_no_python(spark):
    plan = op4_line_dedup(spark, corpus.SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
