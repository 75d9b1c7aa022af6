"""Registered queries of the corpus operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from .chat import OP3_SQL, op3_chat_format
from .codebooks import OP12_SQL, op12_codebook_codes
from .decontaminate import op4_decontaminate
from .hilbert import op2_hilbert_shards
from .hnsw import op7_hnsw_search
from .infill import OP11_SQL, op11_infill_index
from .jaccard import op6_jaccard_join
from .lattice import op13_lattice_score
from .licenses import op1_license_scan
from .mixing import op10_pivotal_mix
from .oracle import OP4_SQL, OP6_SQL, OP9_SQL
from .substrings import op9_suffix_dedup
from .tokenfiles import op8_token_files
from .toxicity import op5_compression_toxicity

REGISTRY = {
    "op1_license_scan": (op1_license_scan, None),           # bounded-error matching
    "op2_hilbert_shards": (op2_hilbert_shards, None),       # DuckDB has no crc32
    "op3_chat_format": (op3_chat_format, OP3_SQL),
    "op4_decontaminate": (op4_decontaminate, OP4_SQL),
    "op5_compression_toxicity": (op5_compression_toxicity, None),   # learned; held-out accuracy in the tests
    "op6_jaccard_join": (op6_jaccard_join, OP6_SQL),
    "op7_hnsw_search": (op7_hnsw_search, None),             # approximate; recall in the tests
    "op8_token_files": (op8_token_files, None),             # a tokenizer
    "op9_suffix_dedup": (op9_suffix_dedup, OP9_SQL),
    "op10_pivotal_mix": (op10_pivotal_mix, None),           # random rounding
    "op11_infill_index": (op11_infill_index, OP11_SQL),
    "op12_codebook_codes": (op12_codebook_codes, OP12_SQL),
    "op13_lattice_score": (op13_lattice_score, None),       # all segmentations; brute force in the tests
}
