"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import collocations, decontaminate, jaccard_join
from .chat import op8_chat
from .collocations import op12_collocations
from .decontaminate import op3_decontamination
from .factorisation import op11_quality
from .jaccard_join import op4_jaccard
from .katz import op9_katz
from .langid import op7_language
from .packing import op6_packing
from .pii import op5_surrogates
from .sharding import op2_sharding
from .simhash import op10_simhash
from .substring_dedup import op1_substring_dedup
from .whitening import op13_whitening

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard": op4_jaccard,
    "op5_surrogates": op5_surrogates,
    "op6_packing": op6_packing,
    "op7_language": op7_language,
    "op8_chat": op8_chat,
    "op9_katz": op9_katz,
    "op10_simhash": op10_simhash,
    "op11_quality": op11_quality,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle() -> dict[str, str]:
    return {"op3_decontamination": decontaminate.ORACLE, "op4_jaccard": jaccard_join.ORACLE, "op12_collocations": collocations.ORACLE}
