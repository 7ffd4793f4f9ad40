"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailcheck.llm import (bpe, conversation_repair, decontamination, exact_dedup, hard_negatives, language_id, packing, shingle_join, spot_signatures, suffix_dedup,
                            token_counts, token_files, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_spot_signatures": spot_signatures.op2_spot_signatures,
    "op3_bpe_round_trip": bpe.op3_bpe_round_trip,
    "op4_token_files": token_files.op4_token_files,
    "op5_warc_archive": warc.op5_warc_archive,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_shingle_join": shingle_join.op8_shingle_join,
    "op9_language_id": language_id.op9_language_id,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_decontamination": decontamination.op12_decontamination,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES: dict[str, str] = {"op7_exact_dedup": exact_dedup.ORACLE, "op12_decontamination": decontamination.ORACLE}
