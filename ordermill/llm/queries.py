"""The operators' registered queries, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm.chats import op7_chat_windows
from ordermill.llm.class_model import op10_class_model
from ordermill.llm.decontamination import op4_decontamination
from ordermill.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from ordermill.llm.languages import op1_language_id
from ordermill.llm.merkle import OP12_SQL, op12_merkle_manifest
from ordermill.llm.personal_data import op5_personal_data
from ordermill.llm.quality import op6_quality
from ordermill.llm.sentencepieces import op3_sentencepiece
from ordermill.llm.simhash import op9_simhash
from ordermill.llm.substrings import OP13_SQL, op13_substring_dedup
from ordermill.llm.token_counts import op8_token_counts
from ordermill.llm.toxicity import op2_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_decontamination": op4_decontamination,
        "op5_personal_data": op5_personal_data,
        "op6_quality": op6_quality,
        "op7_chat_windows": op7_chat_windows,
        "op8_token_counts": op8_token_counts,
        "op9_simhash": op9_simhash,
        "op10_class_model": op10_class_model,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_substring_dedup": op13_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_hard_negatives": OP11_SQL,
        "op12_merkle_manifest": OP12_SQL,
        "op13_substring_dedup": OP13_SQL,
    }
