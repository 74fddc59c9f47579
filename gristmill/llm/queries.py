"""The named queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import centroids, decontaminate, embedding_dedup, html_text, language, line_dedup, lm_scoring
from gristmill.llm import packing, perplexity, piece_codec, runs, simhash, substring_dedup

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_lm_scoring": lm_scoring.op1_lm_scoring,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_embedding_dedup": embedding_dedup.op3_embedding_dedup,
        "op4_simhash": simhash.op4_simhash,
        "op5_html_text": html_text.op5_html_text,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_quality": perplexity.op7_quality,
        "op8_packing": packing.op8_packing,
        "op9_language": language.op9_language,
        "op10_decontamination": decontaminate.op10_decontamination,
        "op11_sentencepiece": piece_codec.op11_sentencepiece,
        "op12_centroids": centroids.op12_centroids,
        "op13_periodic_runs": runs.op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.OP2_SQL, "op10_decontamination": decontaminate.OP10_SQL, "op12_centroids": centroids.OP12_SQL}
