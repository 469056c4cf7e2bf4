"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, langid, lm, media, near_dedup, oracles, packing, repeats, runs, secrets, toxicity, urls, vector_codes, vectors

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = (near_dedup.op1_minhash_near_dedup, repeats.op2_suffix_array_dedup, lm.op3_lm_scoring, media.op4_media, packing.op5_packing, bpe.op6_bpe, langid.op7_language_id, secrets.op8_secret_scans, vectors.op9_embedding_near_dedup, urls.op10_url_filters, runs.op11_periodic_runs, toxicity.op12_toxicity, vector_codes.op13_vector_codes)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": oracles.NEAR_DEDUP,
        "op2_suffix_array_dedup": oracles.REPEATS,
        "op9_embedding_near_dedup": oracles.VECTORS,
        "op10_url_filters": urls.ORACLE,
        "op11_periodic_runs": runs.ORACLE,
        "op13_vector_codes": vector_codes.ORACLE,
    }
