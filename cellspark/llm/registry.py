"""The text operators' queries, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontamination, encoding, jaccard, lm, media, oracles, packing, pii, runs, sharding, substrings, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_warc": warc.op2_warc,
    "op3_jaccard": jaccard.op3_jaccard,
    "op4_tokens": encoding.op4_tokens,
    "op5_lm": lm.op5_lm,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_sharding": sharding.op7_sharding,
    "op8_packing": packing.op8_packing,
    "op9_media": media.op9_media,
    "op10_substrings": substrings.op10_substrings,
    "op11_runs": runs.op11_runs,
    "op12_alignment": alignment.op12_alignment,
    "op13_pii": pii.op13_pii,
}

ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL
