"""Registered queries of the package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm import (
    byte_bpe,
    collocations,
    cover_suffixes,
    exact_dedup,
    fill_middle,
    main_text,
    mixing,
    passages,
    quality_rules,
    shards,
    simhash,
    token_store,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        token_store.op1_token_files,
        shards.op2_proportional_interleave,
        quality_rules.op3_quality_cascade,
        passages.op4_compact_windows,
        main_text.op5_main_text,
        byte_bpe.op6_byte_bpe,
        mixing.op7_curriculum_mix,
        exact_dedup.op8_exact_dedup,
        simhash.op9_simhash,
        url_filter.op10_host_reputation,
        cover_suffixes.op11_cover_suffixes,
        fill_middle.op12_fill_in_middle,
        collocations.op13_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op3_quality_cascade": quality_rules.ORACLE,
    "op7_curriculum_mix": mixing.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op12_fill_in_middle": fill_middle.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
