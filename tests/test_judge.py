"""Judge prompt, judge-output parsing and endpoint text extraction."""

import json

import pytest

from evalspark.functions import judge as J


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    return [r.p.asDict() for r in J.parse_judgements(df, "r", "p").collect()]


def test_parse_shapes(spark):
    got = parse(spark, [
        'Here: {"score": 4, "reasoning": "ok", "strengths": ["a"], "weaknesses": []} done',
        '{"score": "3", "reasoning": "string score"}',
        '{"reasoning": "no score"}',
        '{"score": 2, "reasoning": }',
        "no json here",
        '{"score": null, "reasoning": "null"}',
        None,
    ])
    assert [g["score"] for g in got] == [4.0, 3.0, 0.0, 2.0, None, None, None]
    assert [g["parse_path"] for g in got] == ["json", "json", "json", "regex", "none", "failed", "none"]
    assert got[0]["strengths"] == ["a"] and got[0]["weaknesses"] == []
    assert got[2]["reasoning"] == "no score"
    assert got[3]["reasoning"] == '{"score": 2, "reasoning": }'
    assert got[4]["reasoning"] == "Could not parse judge response: no json here"
    assert got[5]["reasoning"].startswith("Evaluation failed: ") and got[5]["error"]


def test_boolean_score_is_numeric(spark):
    got = parse(spark, ['{"score": true}', '{"score": false, "reasoning": "r"}', '{"score": [1]}'])
    assert [g["score"] for g in got] == [1.0, 0.0, None]
    assert [g["parse_path"] for g in got] == ["json", "json", "failed"]


def test_fallback_takes_one_digit(spark):
    got = parse(spark, ['"score": 10, broken {', '{"score" :  45 ,}'])
    assert [g["score"] for g in got] == [1.0, 4.0]


def test_unparsed_message_is_cut_to_200(spark):
    got = parse(spark, ["x" * 500])
    assert got[0]["reasoning"] == "Could not parse judge response: " + "x" * 200


def test_judge_prompt_template(spark):
    df = spark.createDataFrame([("P?", "R.", None), ("P?", "R.", ""), ("P?", None, "T")],
                               "prompt string, response string, ground_truth string")
    out = [r[0] for r in df.select(J.judge_prompt("prompt", "response", "ground_truth")).collect()]
    want = J.JUDGE_PROMPT_TEMPLATE.replace("{prompt}", "P?").replace("{response}", "R.")
    assert out[0] == want.replace("{ground_truth}", "N/A")
    assert out[1] == out[0]
    assert "**Response:** None" in out[2] and "**Ground Truth (if available):** T" in out[2]
    assert '"score": <1-5>' in out[0]


@pytest.mark.parametrize("body,text,judge_text", [
    ({"predictions": ["p0"]}, "p0", "p0"),
    ({"predictions": [{"content": "p1"}]}, "p1", "p1"),
    ({"choices": [{"message": {"content": "c2"}}]}, "c2", "c2"),
    ({"choices": [{"message": {"role": "x"}}]}, "", ""),
    ({"choices": [{"text": "c3"}]}, "c3", '{"choices": [{"text": "c3"}]}'),
    ({"predictions": [{"other": 1}], "choices": [{"text": "t"}]}, "t", None),
    ({"other": 1}, '{"other": 1}', '{"other": 1}'),
])
def test_extract_response_text(spark, body, text, judge_text):
    raw = json.dumps(body)
    df = spark.createDataFrame([(raw,)], "b string")
    r = df.select(J.extract_response_text("b").alias("t"), J.extract_response_text("b", False).alias("j")).first()
    assert r.t == text
    assert r.j == (raw if judge_text is None else judge_text)


def test_duplicate_keys_keep_the_last_value(spark):
    got = parse(spark, ['{"score": 3, "score": 4, "reasoning": "twice"}'])
    assert got[0]["score"] == 4.0 and got[0]["parse_path"] == "json" and got[0]["reasoning"] == "twice"


def test_column_form_equals_frame_form(spark):
    texts = ['Here: {"score": 4, "strengths": ["a"]} x', '{"score": "3"}', '{"reasoning": "r"}',
             '{"score": 2, "reasoning": }', "no json", '{"score": null}', None, '{"score": true}']
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    a = [r.p.asDict() for r in df.select(J.parse_judgement("r").alias("p")).collect()]
    b = [r.p.asDict() for r in J.parse_judgements(df, "r", "p").collect()]
    assert a == b


def test_text_after_the_object_is_not_json(spark):
    got = parse(spark, ['{"score": 4.5, "reasoning": "x"} tail }', '{"score": 2} and {"score": 5}', 'so: {"score": 4.5} ok',
                        '{"score": 3}, "z": {"b": 1}', '{"score": 3}} {"a": 1}'])
    assert [(g["score"], g["parse_path"]) for g in got] == [(4.0, "regex"), (2.0, "regex"), (4.5, "json"), (3.0, "regex"), (3.0, "regex")]
    body = '{"predictions": ["p"]} trailing'
    r = spark.createDataFrame([(body,)], "b string").select(J.extract_response_text("b").alias("t")).first()
    assert r.t == body
