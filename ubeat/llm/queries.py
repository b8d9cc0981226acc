"""Registered queries of the operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from ubeat.llm import bestfit, blockdedup, chat, decontamination, fingerprints, hardneg, mixing, prefixtrie, sharding, simhash, suffixdedup, toxicity, urlfilter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontamination.op1_decontaminate,
        "op2_urls": urlfilter.op2_urls,
        "op2_urls_share": urlfilter.op2_urls_share,
        "op3_substring_dedup": blockdedup.op3_substring_dedup,
        "op4_suffix_dedup": suffixdedup.op4_suffix_dedup,
        "op5_simhash": simhash.op5_simhash,
        "op6_mix_sources": mixing.op6_mix_sources,
        "op7_shard": sharding.op7_shard,
        "op8_fingerprints": fingerprints.op8_fingerprints,
        "op9_chat": chat.op9_chat,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_prefix_trie": prefixtrie.op11_prefix_trie,
        "op12_hard_negatives": hardneg.op12_hard_negatives,
        "op13_best_fit": bestfit.op13_best_fit,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_urls": urlfilter.SQL, "op6_mix_sources": mixing.SQL, "op11_prefix_trie": prefixtrie.SQL,
            "op12_hard_negatives": hardneg.SQL}
