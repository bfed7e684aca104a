"""Queries of this package over the driver tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import codes, licenses, phrases, topk
from tierlake.llm.brown import op6_brown
from tierlake.llm.decontaminate import op9_decontaminate
from tierlake.llm.language import op5_language
from tierlake.llm.resample import op8_resample
from tierlake.llm.rules import op13_quality_rules
from tierlake.llm.simhash import op10_simhash
from tierlake.llm.token_counts import op4_token_counts
from tierlake.llm.tokens import op1_sentencepiece
from tierlake.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_topk": topk.op2_topk,
    "op3_licenses": licenses.op3_licenses,
    "op4_token_counts": op4_token_counts,
    "op5_language": op5_language,
    "op6_brown": op6_brown,
    "op7_toxicity": op7_toxicity,
    "op8_resample": op8_resample,
    "op9_decontaminate": op9_decontaminate,
    "op10_simhash": op10_simhash,
    "op11_vector_codes": codes.op11_vector_codes,
    "op12_phrases": phrases.op12_phrases,
    "op13_quality_rules": op13_quality_rules,
}

# Iterative, learned and tokenizing operators are tested against brute force instead.
ORACLES: dict[str, str] = {
    "op2_topk": topk.ORACLE,
    "op3_licenses": licenses.ORACLE,
    "op11_vector_codes": codes.ORACLE,
    "op12_phrases": phrases.ORACLE,
}
