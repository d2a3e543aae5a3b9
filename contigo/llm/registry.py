"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import chat, jaccard, media, mixing, packing, pii, quality_model, quality_rules, repeats, toxicity


def queries() -> dict[str, Callable]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_media_tiff": media.op2_media_tiff,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_jaccard_join": jaccard.op5_jaccard_join,
        "op6_quality_model": quality_model.op6_quality_model,
        "op7_chat_formatting": chat.op7_chat_formatting,
        "op8_mixing": mixing.op8_mixing,
        "op9_pii_surrogates": pii.op9_pii_surrogates,
        "op10_repeats": repeats.op10_repeats,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": quality_rules.SQL,
        "op5_jaccard_join": jaccard.SQL,
        "op7_chat_formatting": chat.SQL,
    }
