"""The operators as registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from orderflow.llm import bpe, chat, decontamination, divergence, embeddings, infill, language, lm, mixing, ngram_join, quality, substrings, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_arc_to_warc": warc.op1_arc_to_warc,
    "op2_line_first_cleaning": quality.op2_line_first_cleaning,
    "op3_divide_skip": ngram_join.op3_divide_skip,
    "op4_log_frequency_bloom": lm.op4_log_frequency_bloom,
    "op5_snapshot_collapse": chat.op5_snapshot_collapse,
    "op6_family_then_svm": language.op6_family_then_svm,
    "op7_spherical_cells": embeddings.op7_spherical_cells,
    "op8_recompression": substrings.op8_recompression,
    "op9_two_tier_bpe": bpe.op9_two_tier_bpe,
    "op10_systematic_mix": mixing.op10_systematic_mix,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_learned_rank_infill": infill.op12_learned_rank_infill,
    "op13_automaton_decontamination": decontamination.op13_automaton_decontamination,
    "pipeline": corpus_pipeline.run,
}

CHECKS: dict[str, str] = {
    "op1_arc_to_warc": warc.OP1_SQL,
    "op2_line_first_cleaning": quality.OP2_SQL,
    "op5_snapshot_collapse": chat.OP5_SQL,
    "op8_recompression": substrings.OP8_SQL,
    "op10_systematic_mix": mixing.OP10_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
    "op12_learned_rank_infill": infill.OP12_SQL,
    "op13_automaton_decontamination": decontamination.OP13_SQL,
}
