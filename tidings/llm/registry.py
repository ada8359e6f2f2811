"""Queries of the training-data operators: name to (builder, oracle SQL or None)."""

from __future__ import annotations

from . import (collision_ann, displacement_fim, exact_dedup, language_ppm, merge_replay, mixing, ngram_join, piece_codec, secret_crf,
               sharding, token_alignment, token_cache, token_order)
from .common import documents

_ON_DOCUMENTS = {
    "op1_hypergeometric_sharding": sharding, "op2_poisson_mixing": mixing, "op3_digest_dedup": exact_dedup,
    "op4_feistel_order": token_order, "op5_piece_codec": piece_codec, "op6_ngram_join": ngram_join,
    "op7_secret_crf": secret_crf, "op8_token_cache": token_cache, "op9_language_ppm": language_ppm,
    "op11_merge_replay": merge_replay, "op12_displacement_fim": displacement_fim, "op13_token_alignment": token_alignment,
}


def _over_documents(module):
    return lambda spark, sf_dir: module.query(spark, documents(spark, sf_dir))


def queries() -> dict:
    found = {name: _over_documents(module) for name, module in _ON_DOCUMENTS.items()}
    found["op10_collision_ann"] = lambda spark, sf_dir: collision_ann.query(
        spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in _ON_DOCUMENTS.items() if hasattr(module, "SQL")}
