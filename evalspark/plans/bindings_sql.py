"""The test-data bindings as SQL text for the DuckDB oracle.

Each entry is one CTE body over the driver tables; ``with_bindings`` builds
the ``WITH`` prefix an oracle query needs (dependencies included, in order).
These mirror ``evalspark.sources.tables`` one for one.
"""

from __future__ import annotations

BINDINGS: dict[str, tuple[tuple[str, ...], str]] = {
    "pairs": ((), """
SELECT concat(cast(u.conv_id AS string), '-', cast(u.turn AS string)) AS prompt_id,
       concat('v', cast(u.conv_id % 3 + 1 AS string)) AS dataset_version,
       cast(1 + u.conv_id % 2 AS string) AS model_version,
       u.text AS prompt, a.text AS response,
       CASE WHEN u.conv_id % 5 = 0 THEN concat('  ', translate(a.text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ' ')
            WHEN u.conv_id % 5 = 1 THEN substr(a.text, 1, 20)
            ELSE u.text END AS ground_truth
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""),
    "prompts": (("pairs",), """
SELECT prompt_id, dataset_version, prompt, ground_truth,
       cast('2024-01-01' AS date) AS created_at, cast('2024-01-02' AS date) AS updated_at FROM pairs"""),
    "responses": ((), """
SELECT cast(event_id AS string) AS response_id, cast(user_id AS string) AS prompt_id,
       cast(user_id % 3 AS string) AS model_version, 'endpoint-a' AS endpoint_name,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE props END AS response,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS latency_ms,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'http_429' ELSE 'success' END AS status,
       CASE WHEN event_type IN ('error', 'signup') THEN concat('message ', cast(user_id % 4 AS string)) END AS error_message,
       cast(ts AS date) AS created_at, concat('run-', cast(user_id % 3 AS string)) AS run_id
FROM events"""),
    "evals": ((), """
SELECT concat(metric_name, '-', cast(k AS string), '-', cast(n AS string)) AS eval_id, metric_name, model_version, v AS metric_value FROM (
  SELECT 'faithfulness' AS metric_name, l_orderkey AS k, l_linenumber AS n, CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS model_version,
         cast(l_discount * 10 * CASE WHEN l_linestatus = 'O' THEN 0.93 ELSE 1.0 END AS double) AS v FROM lineitem
  UNION ALL SELECT 'judge_score', l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END,
         cast((1 + l_linenumber % 5) * CASE WHEN l_linestatus = 'O' THEN 0.85 ELSE 1.0 END AS double) FROM lineitem
  UNION ALL SELECT 'answer_relevance', l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END,
         cast(l_quantity / 50 AS double) FROM lineitem
  UNION ALL SELECT 'latency_p95', l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END,
         cast(l_extendedprice / 100 * CASE WHEN l_linestatus = 'O' THEN 1.08 ELSE 1.0 END AS double) FROM lineitem
) x"""),
    "summary": ((), """
SELECT m.model_version, m.run_id, m.metric_name, m.metric_mean, m.metric_std, m.sample_size, m.created_at,
       '1' AS baseline_version, b.metric_mean AS baseline_mean,
       cast(m.sample_size % 100 AS double) / 100 AS p_value,
       CASE (cast(m.model_version AS int) + m.y) % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'FAIL' END AS outcome,
       CASE WHEN m.sample_size % 2 = 0 THEN '{"is_regression": true}' WHEN m.sample_size % 3 = 0 THEN '{"is_regression": null}'
            ELSE '{"is_regression": false}' END AS outcome_reason
FROM (SELECT substr(o_orderpriority, 1, 1) AS model_version, year(o_orderdate) AS y,
             concat('run-', cast(9999 - year(o_orderdate) AS string)) AS run_id,
             CASE o_custkey % 5 WHEN 0 THEN 'faithfulness' WHEN 1 THEN 'answer_relevance' WHEN 2 THEN 'judge_score' WHEN 3 THEN 'rouge_l' ELSE 'latency_p95' END AS metric_name,
             avg(o_totalprice) AS metric_mean, stddev_pop(o_totalprice) AS metric_std, count(*) AS sample_size, max(cast(o_orderdate AS date)) AS created_at
      FROM orders GROUP BY 1, 2, 3, 4) m
LEFT JOIN (SELECT year(o_orderdate) AS y,
             CASE o_custkey % 5 WHEN 0 THEN 'faithfulness' WHEN 1 THEN 'answer_relevance' WHEN 2 THEN 'judge_score' WHEN 3 THEN 'rouge_l' ELSE 'latency_p95' END AS metric_name,
             avg(o_totalprice) AS metric_mean
      FROM orders WHERE substr(o_orderpriority, 1, 1) = '1' GROUP BY 1, 2) b
ON b.y = m.y AND b.metric_name = m.metric_name"""),
    "said": ((), r"""
SELECT reply_id, k, t, replace(replace(replace(replace(replace(t, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS q
FROM (SELECT concat(conv_id, '-', turn) AS reply_id, conv_id + turn AS k,
             concat('He said "{', substr(text, 1, 40), '}"', chr(10), '\ ', text) AS t FROM conversations)"""),
    "judge_texts": (("said",), r"""
SELECT reply_id, CASE k % 10
  WHEN 0 THEN concat('Here: {"score": ', k % 5 + 1, ', "reasoning": "', q, '", "strengths": ["', q, '", "b"], "weaknesses": []} done')
  WHEN 1 THEN concat('{"score": "3", "reasoning": "', q, '"}')
  WHEN 2 THEN concat('{"reasoning": "', q, '"}')
  WHEN 3 THEN concat('{"score": ', k % 5 + 1, ', "reasoning": "', t, '"}')
  WHEN 4 THEN concat('no score: ', t)
  WHEN 5 THEN concat('{"score": null, "reasoning": "', q, '"}')
  WHEN 6 THEN concat('{"score": 4.5, "reasoning": "', q, '"} tail }')
  WHEN 7 THEN concat('{"score": 2, "reasoning": "', q, '"} and {"score": 5}')
  WHEN 8 THEN concat('```json', chr(10), '{"score": 4.5,', chr(10), ' "reasoning": "', q, '",', chr(10), ' "weaknesses": ["x"]}', chr(10), '```')
  END AS result FROM said"""),
    "endpoint_json": (("said",), r"""
SELECT reply_id, CASE k % 8
  WHEN 0 THEN concat('{"predictions": ["', q, '"]}') WHEN 1 THEN concat('{"predictions": [{"content": "', q, '"}]}')
  WHEN 2 THEN concat('{"choices": [{"message": {"role": "assistant", "content": "', q, '"}}]}')
  WHEN 3 THEN concat('{"choices": [{"text": "', q, '"}]}') WHEN 4 THEN concat('{"other": "', q, '"}')
  WHEN 5 THEN concat('{"predictions": ["', t, '"]}') WHEN 6 THEN concat('{"predictions": ["', q, '"]} trailing') ELSE t END AS body FROM said"""),
    "chunks": ((), """
SELECT cast(doc_id AS string) AS chunk_id, concat('v', cast(doc_id % 3 + 1 AS string)) AS dataset_version,
       lang AS source_collection, source, trim(text) AS source_text,
       cast('2024-01-01' AS date) AS created_at
FROM documents WHERE length(trim(text)) >= 50"""),
    "qa": (("chunks",), """
SELECT chunk_id, concat('Q', cast(i AS string), ': ', md5(source_text)) AS question,
       concat('A', cast(i AS string), ': ', md5(concat(source_text, '|', cast(i AS string)))) AS ground_truth, source_text, dataset_version
FROM chunks CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2) n
WHERE cast(chunk_id AS bigint) % 7 <> 0 AND (i = 1 OR cast(chunk_id AS bigint) % 2 = 0)"""),
    "run_events": ((), """
SELECT cast(user_id AS string) AS run_id, event_type AS k, props AS v, ts, event_id FROM events"""),
    "cov_responses": ((), """
SELECT cast(doc_id AS string) AS response_id, lang AS model_version, source AS run_id FROM documents"""),
    "cov_evals": ((), """
SELECT cast(doc_id AS string) AS response_id, 'quality' AS metric_name, cast(quality AS double) AS metric_value FROM labels
UNION ALL
SELECT cast(doc_id AS string), 'toxic', cast(toxic AS double) FROM labels"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for dep in BINDINGS[n][0]:
            visit(dep)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_bindings(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` for the named bindings plus extra CTEs."""
    parts = [f"{n} AS ({BINDINGS[n][1]}\n)" for n in _order(names)]
    parts += [f"{n} AS ({body}\n)" for n, body in (extra or [])]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"
