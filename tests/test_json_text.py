import json

from docloom.functions.json_text import first_object, json_object


def test_objects_in_prose_and_fences():
    x = {"title": "t}", "say": 'a "quoted" {brace', "in": {"deep": [1, {"a": None}]}, "é": "한글"}
    raw = json.dumps(x, ensure_ascii=False)
    for text in (raw, f"  {raw}\n", f"Here it is:\n{raw}\nThanks {{}}!", f"/no_think\n```json\n{raw}\n```\n", f"```\n{raw}```", f"so: ```json\nResult {raw} end``` {{}}"):
        assert first_object(text) == x
    assert first_object("{}") == {} and first_object('[{"a": 1}]') == {"a": 1}


def test_absent_and_broken_objects():
    for text in (None, "", "no json at all", '{"a": 1', "{a: 1}", "}{", "```json\n```", "{" * 100_000, '{"a": "' + "x" * 1_000_000):
        assert first_object(text) is None
    assert first_object('see {this}: {"a": 1} and {"b": 2}') is None
    assert first_object('see {this}: {"a": 1} and {"b": 2}', any_brace=True) == {"a": 1}


def test_column(spark):
    df = spark.createDataFrame([(1, 'Sure: {"a": [1, 2]}.'), (2, "none"), (3, None)], "k int, t string")
    assert {r.k: r.j for r in df.select("k", json_object()("t").alias("j")).collect()} == {1: '{"a": [1, 2]}', 2: None, 3: None}
    assert df.limit(0).select(json_object()("t").alias("j")).collect() == []
