"""Judge prompts, judge-output parsing and endpoint text extraction as native
column expressions (F8-F11, F24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.text import WS_CLASS

# The judge prompt template (placeholders {prompt},
# {response}, {ground_truth}; ground truth falls back to "N/A").
JUDGE_PROMPT_TEMPLATE = """You are an expert evaluator judging the quality of an AI assistant's response.

**Prompt:** {prompt}

**Response:** {response}

**Ground Truth (if available):** {ground_truth}

Evaluate the response on a scale of 1-5:
- 1: Poor - Completely irrelevant, incorrect, or unhelpful
- 2: Below Average - Major issues with accuracy or relevance
- 3: Average - Adequate response with some issues
- 4: Good - Accurate and helpful with minor issues
- 5: Excellent - Perfect or near-perfect response

Provide your evaluation in JSON format:
{
  "score": <1-5>,
  "reasoning": "<brief explanation>",
  "strengths": ["<strength1>", "<strength2>"],
  "weaknesses": ["<weakness1>"]
}

Respond with ONLY the JSON object, no additional text."""

# Message prefixes of failed and unparsable judgements.
FAILED_PREFIX = "Evaluation failed: "
UNPARSED_PREFIX = "Could not parse judge response: "
UNPARSED_CHARS = 200
SCORE_NOT_NUMBER = "score is not a number"
SCORE_FALLBACK = '"score"' + WS_CLASS + "*:" + WS_CLASS + "*([0-9])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _template_parts(template: str) -> tuple[list[str], list[str]]:
    """Split the template into literal pieces and placeholder names."""
    pieces, names, rest = [], [], template
    for name in ("prompt", "response", "ground_truth"):
        head, rest = rest.split("{" + name + "}", 1)
        pieces.append(head)
        names.append(name)
    pieces.append(rest)
    return pieces, names


def judge_prompt(prompt, response, ground_truth, template: str = JUDGE_PROMPT_TEMPLATE) -> Column:
    """F8: the filled judge prompt. Missing or empty truth -> 'N/A'; a
    missing prompt or response prints as 'None' like Python formatting."""
    pieces, _ = _template_parts(template)
    vals = [
        F.coalesce(_c(prompt), F.lit("None")),
        F.coalesce(_c(response), F.lit("None")),
        F.coalesce(F.nullif(_c(ground_truth), F.lit("")), F.lit("N/A")),
    ]
    parts: list[Column] = []
    for piece, val in zip(pieces, vals):
        parts += [F.lit(piece), val]
    parts.append(F.lit(pieces[-1]))
    return F.concat(*parts)


def _is_whole_json(j: Column) -> Column:
    """Whether the text is one JSON value with nothing after it. Spark's JSON
    functions stop at the end of the first value, so the text is read as a
    member between two others."""
    members = F.json_object_keys(F.concat(F.lit('{"a":'), j, F.lit(',"z":0}')))
    return F.coalesce(members == F.array(F.lit("a"), F.lit("z")), F.lit(False))


JUDGEMENT_FIELDS = "score string, reasoning string, strengths string, weaknesses string"


def _judgement(r: Column, step) -> Column:
    """The parse as a chain of steps; ``step(name, expr)`` either returns the
    expression (column form) or stores it as a column and returns a
    reference to it (frame form), so each step is computed once per row."""
    j = step("j", F.regexp_extract(r, r"(?s)\{.*\}", 0))
    # key presence from the key list; field values from one struct of string
    # fields (nested values keep their JSON text; a repeated key keeps its
    # last value, like json.loads; a map would fail on duplicate keys)
    keys = step("keys", F.when(F.length(j) > 0, F.json_object_keys(j)))
    m = step("m", F.when(keys.isNotNull(), F.from_json(j, JUDGEMENT_FIELDS)))
    valid = step("valid", keys.isNotNull() & _is_whole_json(j))
    has = lambda k: F.array_contains(keys, k)
    raw = m["score"]
    # JSON booleans are numbers to Python's float(): true -> 1.0, false -> 0.0
    num = F.when(raw == "true", F.lit(1.0)).when(raw == "false", F.lit(0.0)).otherwise(raw.try_cast("double"))
    digit = step("digit", F.when(~valid, F.regexp_extract(r, SCORE_FALLBACK, 1)))
    p = step("path", F.when(r.isNull(), F.lit("none"))
             .when(valid & has("score") & num.isNull(), F.lit("failed"))
             .when(valid, F.lit("json"))
             .when(F.length(digit) > 0, F.lit("regex"))
             .otherwise(F.lit("none")))
    empty = F.array().cast("array<string>")
    arr = lambda k: F.coalesce(F.from_json(m[k], "array<string>"), empty)
    score = F.when(p == "json", F.when(has("score"), num).otherwise(F.lit(0.0))) \
             .when(p == "regex", digit.cast("double"))
    reasoning = F.when(p == "json", F.when(has("reasoning"), m["reasoning"]).otherwise(F.lit(""))) \
                 .when(p == "regex", r) \
                 .when(p == "failed", F.lit(FAILED_PREFIX + SCORE_NOT_NUMBER)) \
                 .otherwise(F.concat(F.lit(UNPARSED_PREFIX),
                                     F.substring(F.coalesce(r, F.lit("None")), 1, UNPARSED_CHARS)))
    return F.struct(
        score.cast("double").alias("score"),
        reasoning.alias("reasoning"),
        F.when(p == "json", arr("strengths")).otherwise(empty).alias("strengths"),
        F.when(p == "json", arr("weaknesses")).otherwise(empty).alias("weaknesses"),
        F.when(p == "failed", F.lit(SCORE_NOT_NUMBER)).alias("error"),
        p.alias("parse_path"),
    )


def parse_judgement(result) -> Column:
    """F10/F11/F24 as one column expression (usable in any ``select``);
    ``parse_judgements`` computes the same struct with each step once."""
    return _judgement(_c(result), lambda _name, expr: expr)


def parse_judgements(df: DataFrame, result: str, out: str = "judgement") -> DataFrame:
    """add ``out`` = struct

    (score, reasoning, strengths, weaknesses, error, parse_path)

    parsed from the judge reply in column ``result``:

    1. the text from the first '{' to the last '}' is parsed as JSON: a
       missing score is 0.0, a string score is cast, a null or non-numeric
       score gives a failed judgement (NULL score, error text, T20);
    2. otherwise a ``"score": <digit>`` fallback takes one digit (T19) and
       keeps the whole reply as reasoning;
    3. otherwise NULL score and the first 200 characters in the message.

    Built in projection steps so the JSON text is extracted and parsed once
    per row.
    """
    state = {"df": df, "cols": []}

    def step(name: str, expr: Column) -> Column:
        col = f"_jp_{name}"
        state["df"] = state["df"].withColumn(col, expr)
        state["cols"].append(col)
        return F.col(col)

    parsed = _judgement(F.col(result), step)
    return state["df"].withColumn(out, parsed).drop(*state["cols"])


def _text_from_variant(v: Column, raw: Column, with_text: bool) -> Column:
    """Key presence is ``variant_get(...) IS NOT NULL`` (a JSON null value is
    a VARIANT null, a missing key is SQL NULL); one type probe per element."""
    vget = lambda path: F.variant_get(v, path, "variant")
    get = lambda path: F.try_variant_get(v, path, "string")
    pred_kind = F.schema_of_variant(vget("$.predictions[0]"))
    choice_is_obj = F.schema_of_variant(vget("$.choices[0]")).startswith("OBJECT")
    out = F.when(pred_kind == "STRING", get("$.predictions[0]")) \
           .when(pred_kind.startswith("OBJECT") & vget("$.predictions[0].content").isNotNull(),
                 get("$.predictions[0].content")) \
           .when(choice_is_obj & vget("$.choices[0].message").isNotNull(),
                 F.coalesce(get("$.choices[0].message.content"), F.lit("")))
    if with_text:
        out = out.when(choice_is_obj & vget("$.choices[0].text").isNotNull(), get("$.choices[0].text"))
    return out.otherwise(raw)


def _parsed(b: Column) -> Column:
    return F.when(_is_whole_json(b), F.try_parse_json(b))


def extract_response_text(body, with_text: bool = True) -> Column:
    """text of a serving-endpoint JSON reply, in this order:
    predictions[0] when a string; predictions[0].content when present;
    choices[0].message.content ('' when the message has none);
    choices[0].text (inference replies only, ``with_text``); else the raw body.
    """
    b = _c(body)
    return _text_from_variant(_parsed(b), b, with_text)


def extract_response_texts(df: DataFrame, body: str, outs: dict[str, bool]) -> DataFrame:
    """F9 for whole frames: the body is parsed to VARIANT once per row, then
    each ``out -> with_text`` column is read from it."""
    df = df.withColumn("_body_v", _parsed(F.col(body)))
    for out, with_text in outs.items():
        df = df.withColumn(out, _text_from_variant(F.col("_body_v"), F.col(body), with_text))
    return df.drop("_body_v")
