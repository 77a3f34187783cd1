"""The registered queries of this package: one for each numbered operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationday.llm.decontaminate import op5_decontamination
from stationday.llm.hard_negatives import op13_hard_negatives
from stationday.llm.katz import op7_katz
from stationday.llm.language import op9_language_id
from stationday.llm.mixing import op3_mixing
from stationday.llm.ngram_join import op4_ngram_join
from stationday.llm.oracle import ORACLE_SQL
from stationday.llm.pii import op1_pii
from stationday.llm.prefix_trie import op12_prefix_trie
from stationday.llm.quality import op8_quality
from stationday.llm.repetition import op10_repetition
from stationday.llm.token_counts import op6_token_counts
from stationday.llm.toxicity import op2_toxicity
from stationday.llm.warc import op11_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_katz": op7_katz,
    "op8_quality": op8_quality,
    "op9_language_id": op9_language_id,
    "op10_repetition": op10_repetition,
    "op11_warc": op11_warc,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
