"""The registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.alignment import op12_alignment
from roadpulse.llm.forest import op4_jaccard
from roadpulse.llm.language import op9_language
from roadpulse.llm.lm import op3_lm
from roadpulse.llm.packing import op2_packing
from roadpulse.llm.paragraphs import op7_paragraphs
from roadpulse.llm.periodic import op13_periodic
from roadpulse.llm.pii import op6_pii
from roadpulse.llm.quality import op8_quality
from roadpulse.llm.rules import op10_rules, op10_sql
from roadpulse.llm.suffixes import op5_suffixes
from roadpulse.llm.templates import op1_templates
from roadpulse.llm.tokens import op11_tokens

_QUERIES = (op1_templates, op2_packing, op3_lm, op4_jaccard, op5_suffixes, op6_pii, op7_paragraphs, op8_quality, op9_language,
            op10_rules, op11_tokens, op12_alignment, op13_periodic)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in _QUERIES}


def all_oracles() -> dict[str, str]:
    return {"op10_rules": op10_sql()}
