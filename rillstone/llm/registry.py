"""Queries of this subpackage by name, and their SQL where there is one."""

from __future__ import annotations

from rillstone.llm.ann import op8_ann
from rillstone.llm.bpe import op5_bpe
from rillstone.llm.decontaminate import OP7_SQL, op7_decontaminate
from rillstone.llm.html_extract import op2_html
from rillstone.llm.jaccard import op3_jaccard
from rillstone.llm.licenses import op1_licenses
from rillstone.llm.maxent import op10_maxent
from rillstone.llm.negatives import OP11_SQL, op11_negatives
from rillstone.llm.ordinal import op9_quality
from rillstone.llm.sharding import op12_sharding
from rillstone.llm.substrings import OP4_SQL, op4_substrings
from rillstone.llm.toxicity import op6_toxicity
from rillstone.llm.variants import op13_variants

QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_html": op2_html,
    "op3_jaccard": op3_jaccard,
    "op4_substrings": op4_substrings,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_ann": op8_ann,
    "op9_quality": op9_quality,
    "op10_maxent": op10_maxent,
    "op11_negatives": op11_negatives,
    "op12_sharding": op12_sharding,
    "op13_variants": op13_variants,
}

ORACLE: dict[str, str] = {
    "op4_substrings": OP4_SQL,
    "op7_decontaminate": OP7_SQL,
    "op11_negatives": OP11_SQL,
}
