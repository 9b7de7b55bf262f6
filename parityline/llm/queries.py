"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from parityline.llm import chat_tools, collocations, exact_dedup, line_dedup, mixing, topk_search
from parityline.llm.bpe import op6_bpe
from parityline.llm.ngram_join import op10_ngram_join
from parityline.llm.quality import op5_quality_rules
from parityline.llm.spelling import op13_spelling_variants
from parityline.llm.token_counts import op4_token_counts
from parityline.llm.token_files import op3_token_files
from parityline.llm.toxicity import op7_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_token_files": op3_token_files,
        "op4_token_counts": op4_token_counts,
        "op5_quality_rules": op5_quality_rules,
        "op6_bpe": op6_bpe,
        "op7_toxicity": op7_toxicity,
        "op8_chat_tools": chat_tools.op8_chat_tools,
        "op9_line_dedup": line_dedup.op9_line_dedup,
        "op10_ngram_join": op10_ngram_join,
        "op11_topk_search": topk_search.op11_topk_search,
        "op12_collocations": collocations.op12_collocations,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": mixing.oracle(),
        "op2_exact_dedup": exact_dedup.ORACLE,
        "op8_chat_tools": chat_tools.ORACLE,
        "op9_line_dedup": line_dedup.ORACLE,
        "op11_topk_search": topk_search.ORACLE,
        "op12_collocations": collocations.ORACLE,
    }
