import compare
import corpus

from llm import preferences
from llm.preferences import answer_pairs, format_pairs, op3_preference_format

PAIRS = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt int"


def test_query_equals_sql(spark):
    assert compare.difference(op3_preference_format(spark, corpus.SF), compare.connect(corpus.SF), preferences.SQL) == ""


def test_prompt_is_rendered_once_and_answers_are_marked(spark):
    head = [("user", "hi"), ("assistant", "<|user|> hello"), ("user", None)]
    rows = [
        (1, head + [("assistant", "yes")], head + [("assistant", "no"), ("user", "why")], 0),
        (2, head, head, None), (3, head, head[:1], None), (4, None, [], None), (5, [(None, None)], [(None, None), ("assistant", "")], None),
    ]
    found = {r.pair_id: r for r in format_pairs(spark.createDataFrame(rows, PAIRS)).collect()}
    one = found[1]
    assert one.n_prompt == 3 and "< |user|> hello" in one.prompt and one.prompt.count("<|user|>") == 2
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["yes<|end|>\n"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["no<|end|>\n"]
    assert (found[2].chosen, found[2].rejected, found[3].rejected) == ("", "", "")
    assert found[4].n_prompt == 0 and found[5].n_prompt == 1
    assert format_pairs(spark.createDataFrame([], PAIRS)).collect() == []


def test_conversation_edges_equal_sql(spark, tmp_path):
    rows = [
        (0, 0, "user", "a", 1), (0, 1, "assistant", "b", 1), (0, 1, "assistant", "b", 1), (0, 2, "user", None, 1), (1, 0, None, "x", 1),
        (1, 5, "assistant", "b", 2), (2, 0, "user", "", 2), (3, 0, "assistant", None, 2), (None, 0, "user", "q", 2), (-1, 0, "assistant", "m", 3),
        (-2, None, "user", "é" * 5000, 3), (9, 0, "assistant", "lone", None), (4, 0, "user", "<|end|>", 1), (5, 0, "assistant", "same", 1), (4, 1, "assistant", "same", 1),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, two int").write.parquet(f"{tmp_path}/conversations.parquet")
    duck = compare.duckdb.connect()
    duck.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare.difference(op3_preference_format(spark, str(tmp_path)), duck, preferences.SQL) == ""
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert answer_pairs(none).collect() == []


def test_main_path_has_no_python(spark):
    plan = op3_preference_format(spark, corpus.SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
