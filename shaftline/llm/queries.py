"""The queries of this subpackage, over whole tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shaftline.llm import block_naming, divergence, url_rules
from shaftline.llm.block_naming import op6_exact_dedup
from shaftline.llm.brown import op1_class_lm
from shaftline.llm.chat import op8_chat_format
from shaftline.llm.divergence import op12_source_divergence
from shaftline.llm.minmax import op10_near_dedup
from shaftline.llm.packing import op9_best_fit_packing
from shaftline.llm.pieces import op4_sentencepiece
from shaftline.llm.repetition import op2_repetition
from shaftline.llm.scan import op11_adaptive_scan
from shaftline.llm.secrets import op5_secret_scan
from shaftline.llm.spelling import op13_spelling_variants
from shaftline.llm.tokens import op7_token_files
from shaftline.llm.url_rules import op3_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_class_lm": op1_class_lm,
    "op2_repetition": op2_repetition,
    "op3_url_filter": op3_url_filter,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_files": op7_token_files,
    "op8_chat_format": op8_chat_format,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_near_dedup": op10_near_dedup,
    "op11_adaptive_scan": op11_adaptive_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_rules.ORACLE,
    "op6_exact_dedup": block_naming.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
