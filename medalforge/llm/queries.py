"""The registered queries of this subpackage, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from . import decontaminate, quality
from .ann import op4_hilbert_neighbours
from .chat import op8_chat_formatting
from .decontaminate import op12_suffix_decontamination
from .jaccard import op5_ngram_jaccard
from .langid import op9_language_id
from .license import op7_license_scan
from .lmscore import op1_lattice_score
from .mixing import op10_pareto_mix
from .quality import op3_quality_rules
from .repair import op11_conversation_repair
from .sampling import op2_gumbel_encoding
from .toxicity import op6_toxicity
from .trie import op13_conversation_trie


def queries() -> dict:
    return {
        "op1_lattice_score": op1_lattice_score,
        "op2_gumbel_encoding": op2_gumbel_encoding,
        "op3_quality_rules": op3_quality_rules,
        "op4_hilbert_neighbours": op4_hilbert_neighbours,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_toxicity": op6_toxicity,
        "op7_license_scan": op7_license_scan,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_language_id": op9_language_id,
        "op10_pareto_mix": op10_pareto_mix,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_suffix_decontamination": op12_suffix_decontamination,
        "op13_conversation_trie": op13_conversation_trie,
    }


def oracle_sql() -> dict[str, str]:
    """The others learn, draw at random, search or compare sets: their tests use brute force instead."""
    return {"op3_quality_rules": quality.ORACLE_SQL, "op12_suffix_decontamination": decontaminate.ORACLE_SQL}
