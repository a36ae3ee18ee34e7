"""Queries of this package and, where SQL can express them, their twins."""

from __future__ import annotations

from wardlake.llm import (
    collocation,
    decontaminate,
    fingerprint,
    hmm,
    html,
    line_dedup,
    ngram_join,
    pieces,
    pii,
    quality,
    shallot,
    toxicity,
    vector_join,
)

QUERIES = {
    "op1_hmm": hmm.run,
    "op2_line_dedup": line_dedup.run,
    "op3_html": html.run,
    "op4_pieces": pieces.run,
    "op5_quality": quality.run,
    "op6_pii": pii.run,
    "op7_toxicity": toxicity.run,
    "op8_ngram_join": ngram_join.run,
    "op9_fingerprint": fingerprint.run,
    "op10_decontaminate": decontaminate.run,
    "op10_decontaminate_near": decontaminate.run_near,
    "op11_vector_join": vector_join.run,
    "op12_shallot": shallot.run,
    "op13_collocation": collocation.run,
}
SQL: dict[str, str] = {
    "op6_pii": pii.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op11_vector_join": vector_join.SQL,
    "op12_shallot": shallot.SQL,
    "op13_collocation": collocation.SQL,
}
