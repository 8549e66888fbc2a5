"""Registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .classifier import op2_quality
from .conversations import op12_conversation_repair
from .decontaminate import op4_decontamination
from .langid import op7_language_id
from .licenses import op10_licenses
from .mixing import op1_mixing
from .near import op5_ngram_jaccard
from .phrases import ORACLE_OP13, op13_collocations
from .repeats import op9_substring_dedup
from .rules import op6_quality_rules
from .secrets import op3_secrets
from .sharding import op8_sharding
from .tokens import op11_token_blocks

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_decontamination": op4_decontamination,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_sharding": op8_sharding,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_licenses": op10_licenses,
    "op11_token_blocks": op11_token_blocks,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {"op13_collocations": ORACLE_OP13}
