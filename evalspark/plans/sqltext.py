"""SQL text helpers shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from evalspark.functions.judge import FAILED_PREFIX, JUDGE_PROMPT_TEMPLATE, SCORE_FALLBACK, SCORE_NOT_NUMBER, \
    UNPARSED_CHARS, UNPARSED_PREFIX, _template_parts
from evalspark.functions.normal import two_sided_p_sql
from evalspark.functions.text import NON_WS_RUN, WS_CHARS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = "(" + " || ".join(f"chr({ord(c)})" for c in WS_CHARS) + ")"
TOKENS_RE = lit(NON_WS_RUN)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def nonempty(x: str) -> str:
    return f"({x} IS NOT NULL AND length({x}) > 0)"


def token_count(x: str) -> str:
    return f"cast(coalesce(len(regexp_extract_all({x}, {TOKENS_RE})), 0) AS double)"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {TOKENS_RE})"


def exact_match(r: str, g: str) -> str:
    return (f"CAST(CASE WHEN {nonempty(r)} AND {nonempty(g)} AND lower({strip(r)}) = lower({strip(g)}) "
            f"THEN 1.0 ELSE 0.0 END AS DOUBLE)")


def contains_match(r: str, g: str) -> str:
    return (f"CAST(CASE WHEN {nonempty(r)} AND {nonempty(g)} AND contains(lower({r}), lower({strip(g)})) "
            f"THEN 1.0 ELSE 0.0 END AS DOUBLE)")


def response_length(r: str) -> str:
    return f"cast(coalesce(length({r}), 0) AS double)"


def lcs_ctes(src: str, key: str, resp: str = "response", ref: str = "ground_truth") -> list[tuple[str, str]]:
    """CTEs computing the token LCS per ``key`` of ``src`` with a recursive
    DP over rows; the result CTE is ``lcs(key, lcs)``."""
    return [
        ("lcs_tok", f"SELECT {key} AS k, CASE WHEN {nonempty(resp)} AND {nonempty(ref)} THEN {tokens(resp)} "
                    f"ELSE [] END AS a, CASE WHEN {nonempty(resp)} AND {nonempty(ref)} THEN {tokens(ref)} "
                    f"ELSE [] END AS b FROM {src}"),
        ("lcs_dp", """SELECT k, 0 AS i, list_transform(range(len(b) + 1), lambda x: 0) AS dp FROM lcs_tok
  UNION ALL
  SELECT d.k, d.i + 1,
         list_reduce(
           list_transform(range(1, len(t.b) + 1),
             lambda j: greatest(d.dp[j + 1], CASE WHEN t.a[d.i + 1] = t.b[j] THEN d.dp[j] + 1 ELSE 0 END)),
           lambda acc, x: list_append(acc, greatest(acc[-1], x)), [0])
  FROM lcs_dp d JOIN lcs_tok t ON t.k = d.k WHERE d.i < len(t.a)"""),
        ("lcs", "SELECT t.k AS k, d.dp[-1] AS lcs, len(t.a) AS m, len(t.b) AS n FROM lcs_tok t "
                "JOIN lcs_dp d ON d.k = t.k AND d.i = len(t.a)"),
    ]


def rouge_from(lcs: str, m: str, n: str) -> str:
    p = f"(cast({lcs} AS double) / {m})"
    r = f"(cast({lcs} AS double) / {n})"
    return f"CASE WHEN {m} > 0 AND {n} > 0 AND {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


def judge_prompt(prompt: str, response: str, truth: str) -> str:
    pieces, _ = _template_parts(JUDGE_PROMPT_TEMPLATE)
    vals = [f"coalesce({prompt}, 'None')", f"coalesce({response}, 'None')",
            f"coalesce(nullif({truth}, ''), 'N/A')"]
    parts = []
    for piece, v in zip(pieces, vals):
        parts += [lit(piece), v]
    parts.append(lit(pieces[-1]))
    return "concat(" + ", ".join(parts) + ")"


def judge_parse_cols(r: str) -> str:
    """score, reasoning, n_strengths, n_weaknesses, error, parse_path."""
    j = f"regexp_extract({r}, '(?s)\\{{.*\\}}', 0)"
    valid = f"(length({j}) > 0 AND json_valid({j}) AND json_type({j}) = 'OBJECT')"
    has = lambda k: f"list_contains(json_keys({j}), '{k}')"
    raw = f"json_extract_string({j}, '$.score')"
    num = f"(CASE WHEN {raw} = 'true' THEN 1.0 WHEN {raw} = 'false' THEN 0.0 ELSE TRY_CAST({raw} AS DOUBLE) END)"
    digit = f"regexp_extract({r}, {lit(SCORE_FALLBACK)}, 1)"
    path = (f"CASE WHEN {r} IS NULL THEN 'none' WHEN {valid} AND {has('score')} AND {num} IS NULL THEN 'failed' "
            f"WHEN {valid} THEN 'json' WHEN length({digit}) > 0 THEN 'regex' ELSE 'none' END")
    arr = lambda k: f"cast(coalesce(len(TRY_CAST(json_extract({j}, '$.{k}') AS VARCHAR[])), 0) AS INTEGER)"
    return f"""
  CASE WHEN ({path}) = 'json' THEN (CASE WHEN NOT {has('score')} THEN 0.0 ELSE {num} END)
       WHEN ({path}) = 'regex' THEN cast({digit} AS double) END AS score,
  CASE WHEN ({path}) = 'json' THEN (CASE WHEN {has('reasoning')} THEN json_extract_string({j}, '$.reasoning') ELSE '' END)
       WHEN ({path}) = 'regex' THEN {r}
       WHEN ({path}) = 'failed' THEN {lit(FAILED_PREFIX + SCORE_NOT_NUMBER)}
       ELSE concat({lit(UNPARSED_PREFIX)}, substr(coalesce({r}, 'None'), 1, {UNPARSED_CHARS})) END AS reasoning,
  CASE WHEN ({path}) = 'json' THEN {arr('strengths')} ELSE cast(0 AS INTEGER) END AS n_strengths,
  CASE WHEN ({path}) = 'json' THEN {arr('weaknesses')} ELSE cast(0 AS INTEGER) END AS n_weaknesses,
  CASE WHEN ({path}) = 'failed' THEN {lit(SCORE_NOT_NUMBER)} END AS error,
  {path} AS parse_path"""


def response_text(raw: str, with_text: bool = True) -> str:
    b = f"(CASE WHEN json_valid({raw}) THEN {raw} END)"

    def kind(p):
        return f"json_type({b}, '{p}')"

    def has(p, k):
        return f"list_contains(json_keys({b}, '{p}'), '{k}')"

    out = (f"CASE WHEN {kind('$.predictions[0]')} = 'VARCHAR' THEN json_extract_string({b}, '$.predictions[0]') "
           f"WHEN {kind('$.predictions[0]')} = 'OBJECT' AND {has('$.predictions[0]', 'content')} "
           f"THEN json_extract_string({b}, '$.predictions[0].content') "
           f"WHEN {kind('$.choices[0]')} = 'OBJECT' AND {has('$.choices[0]', 'message')} "
           f"THEN coalesce(json_extract_string({b}, '$.choices[0].message.content'), '') ")
    if with_text:
        out += (f"WHEN {kind('$.choices[0]')} = 'OBJECT' AND {has('$.choices[0]', 'text')} "
                f"THEN json_extract_string({b}, '$.choices[0].text') ")
    return out + f"ELSE {raw} END"


def p_value(z: str) -> str:
    return two_sided_p_sql(z)
