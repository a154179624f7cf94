"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayrate.llm.bpe import op5_bpe_round_trip
from stayrate.llm.chat import op7_chat_format
from stayrate.llm.chunks import op4_substring_dedup
from stayrate.llm.decontaminate import op1_decontamination
from stayrate.llm.jaccard import op3_ngram_jaccard
from stayrate.llm.language import op10_language_id
from stayrate.llm.licenses import op9_license_scan
from stayrate.llm.multiindex import op8_embedding_near_dedup
from stayrate.llm.pii import op13_pii
from stayrate.llm.quality import op6_quality
from stayrate.llm.repair import op11_structure_repair
from stayrate.llm.toxicity import op2_toxicity
from stayrate.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_quality": op6_quality,
    "op7_chat_format": op7_chat_format,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_language_id": op10_language_id,
    "op11_structure_repair": op11_structure_repair,
    "op12_whitening": op12_whitening,
    "op13_pii": op13_pii,
}
