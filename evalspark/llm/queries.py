"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontam, divergence, fingerprint, jaccard, langid, licenses, lm, minhash, packing, pii, quality, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": langid.op1_language_id,
    "op2_pii": pii.op2_pii,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_fingerprint": fingerprint.op4_fingerprint,
    "op5_quality": quality.op5_quality,
    "op6_decontamination": decontam.op6_decontamination,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_lm_scoring": lm.op10_lm_scoring,
    "op11_collocations": collocations.op11_collocations,
    "op12_minhash_dedup": minhash.op12_minhash_dedup,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op9_license_scan": licenses.OP9_SQL,
    "op7_suffix_dedup": suffixes.OP7_SQL,
    "op8_jaccard_join": jaccard.OP8_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_minhash_dedup": minhash.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
