"""Queries of this subpackage: ``opN_<name>`` applies operator N with its
production parameters to its whole table."""

from __future__ import annotations

from . import (byte_bpe, cross_polytope, language_id, line_templates, packing, periodic_runs, prefix_trie, quality_votes, repeats,
               sharding, token_files, toxicity, weighted_minhash)

QUERIES = {f.__name__: f for f in (
    weighted_minhash.op1_weighted_minhash,
    repeats.op2_repeats,
    quality_votes.op3_quality_votes,
    byte_bpe.op4_byte_bpe,
    line_templates.op5_line_templates,
    sharding.op6_sharding,
    cross_polytope.op7_cross_polytope,
    packing.op8_packing,
    token_files.op9_token_files,
    language_id.op10_language_id,
    toxicity.op11_toxicity,
    prefix_trie.op12_prefix_trie,
    periodic_runs.op13_periodic_runs,
)}

ORACLE_SQL: dict[str, str] = {}
