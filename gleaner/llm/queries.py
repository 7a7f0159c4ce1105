"""The operators' registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    chat,
    decontaminate,
    fim,
    fingerprints,
    jaccard,
    licenses,
    lines,
    pieces,
    quality,
    repeats,
    secrets,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.query,
    "op2_sentencepiece": pieces.query,
    "op3_fingerprints": fingerprints.query,
    "op4_secrets": secrets.query,
    "op5_substring_dedup": repeats.query,
    "op6_decontamination": decontaminate.query,
    "op7_toxicity": toxicity.query,
    "op8_licenses": licenses.query,
    "op9_chat": chat.query,
    "op10_jaccard_join": jaccard.query,
    "op11_line_dedup": lines.query,
    "op12_fill_in_middle": fim.query,
    "op13_tokenizer_alignment": alignment.query,
}

ORACLE: dict[str, str] = {
    "op4_secrets": secrets.ORACLE,
    "op5_substring_dedup": repeats.ORACLE,
    "op6_decontamination": decontaminate.ORACLE,
    "op8_licenses": licenses.ORACLE,
    "op9_chat": chat.ORACLE,
    "op10_jaccard_join": jaccard.ORACLE,
    "op11_line_dedup": lines.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
}
