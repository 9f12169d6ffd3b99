"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from .bpe import op8_bpe
from .covertree import OP6_SQL, op6_topk
from .licenses import OP3_SQL, op3_licenses
from .main_text import op4_main_text
from .mixing import op5_mixing
from .pieces import op11_pieces
from .pii import op1_pii
from .quality import op10_quality
from .simhash import op2_simhash
from .syncmers import op9_syncmers
from .token_shards import op7_token_shards
from .variants import op12_variants
from .vector_codes import op13_vector_codes

QUERIES = {
    "op1_pii": op1_pii,
    "op2_simhash": op2_simhash,
    "op3_licenses": op3_licenses,
    "op4_main_text": op4_main_text,
    "op5_mixing": op5_mixing,
    "op6_topk": op6_topk,
    "op7_token_shards": op7_token_shards,
    "op8_bpe": op8_bpe,
    "op9_syncmers": op9_syncmers,
    "op10_quality": op10_quality,
    "op11_pieces": op11_pieces,
    "op12_variants": op12_variants,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op3_licenses": OP3_SQL,
    "op6_topk": OP6_SQL,
}
