"""evalspark: Spark-native evaluation analytics for language-model outputs.

Every public function takes DataFrames (or column expressions) and returns a
DataFrame or a Column; no library code collects rows to the driver.

The main entry points, importable from the package:

    text_metrics, rouge_l, exact_match, contains_match   text metrics (F1-F7)
    judge_prompt, parse_judgement(s), extract_response_text judge helpers
    latency_stats, latency_trends, error_analysis          response aggregates
    mann_whitney, version_means                            two-sample statistics
    compare_metrics, regression_report, metric_summary_rows, alert_payload
    batch_infer, batch_judge, generate_qa                  caller-supplied calls
    hard_negatives, build_testset                          test-set building
    KeyedTable, create_catalog                       keyed storage
"""

__version__ = "0.1.0"

from evalspark.functions.judge import extract_response_text, judge_prompt, parse_judgement, parse_judgements  # noqa: E402
from evalspark.functions.text import contains_match, exact_match, rouge_l, text_metrics  # noqa: E402
from evalspark.operators.batch import batch_infer, batch_judge, generate_qa  # noqa: E402
from evalspark.operators.latency import error_analysis, latency_stats, latency_trends  # noqa: E402
from evalspark.operators.regression import (  # noqa: E402
    alert_payload,
    compare_metrics,
    metric_summary_rows,
    regression_report,
)
from evalspark.operators.stats import mann_whitney, version_means  # noqa: E402
from evalspark.operators.testgen import build_testset, hard_negatives  # noqa: E402
from evalspark.sources.store import KeyedTable, create_catalog  # noqa: E402

__all__ = [
    "text_metrics", "rouge_l", "exact_match", "contains_match",
    "judge_prompt", "parse_judgement", "parse_judgements", "extract_response_text",
    "latency_stats", "latency_trends", "error_analysis",
    "mann_whitney", "version_means",
    "compare_metrics", "regression_report", "metric_summary_rows", "alert_payload",
    "batch_infer", "batch_judge", "generate_qa",
    "hard_negatives", "build_testset",
    "KeyedTable", "create_catalog",
]
