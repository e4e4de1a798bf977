"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chat, imatch, language, negatives, packing, periods, quality, shards, simhash, topk, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (toxicity.op1_toxicity, packing.op2_packing, simhash.op3_simhash, url_filter.op4_url_filter, quality.op5_quality, shards.op6_shards, imatch.op7_fingerprints, topk.op8_topk, byte_bpe.op9_byte_bpe, language.op10_language, periods.op11_periods, chat.op12_chat_format, negatives.op13_hard_negatives)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": url_filter.oracle(), "op6_shards": shards.oracle(), "op8_topk": topk.oracle(), "op12_chat_format": chat.oracle(), "op13_hard_negatives": negatives.oracle()}
