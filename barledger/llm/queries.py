"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barledger.llm import centroids, chat, divergence, fixity, idcoder, importance, licenses, nbest, oracles, oracles_drawn
from barledger.llm import segments, suffix_dedup, superminhash, templates, token_cache
from barledger.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(report: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: report(*(table(spark, sf_dir, t) for t in tables))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.report(rows.unionByName(chat.planted(spark)))


def queries() -> dict[str, Query]:
    return {
        "op1_divergence": _over(divergence.report, "documents"),
        "op2_suffix_dedup": _over(suffix_dedup.report, "documents"),
        "op3_id_coder": _over(idcoder.report, "documents"),
        "op4_chat_format": _op4,
        "op5_token_cache": _over(token_cache.report, "documents"),
        "op6_fixity": _over(fixity.report, "pages"),
        "op7_superminhash": _over(superminhash.report, "documents"),
        "op8_nbest": _over(nbest.report, "documents"),
        "op9_segments": _over(segments.report, "documents", "labels"),
        "op10_templates": _over(templates.report, "documents", "benchmark"),
        "op11_importance": _over(importance.report, "documents", "benchmark"),
        "op12_licenses": _over(licenses.report, "documents"),
        "op13_centroids": _over(centroids.report, "embeddings"),
    }


def oracle_sql() -> dict[str, str]:
    """op3, op5 and op8 need a tokenizer, op9 a fitted model, op10 a mapping chosen by vote: tests use brute force."""
    return {
        "op1_divergence": oracles.OP1,
        "op2_suffix_dedup": oracles.OP2,
        "op4_chat_format": chat.SQL,
        "op6_fixity": fixity.SQL,
        "op7_superminhash": oracles.OP7,
        "op11_importance": oracles_drawn.OP11,
        "op12_licenses": oracles_drawn.OP12,
        "op13_centroids": oracles_drawn.OP13,
    }
