"""The queries of this package and the SQL that some of them must equal."""

from __future__ import annotations

from planweave.llm import hnsw, katz, langid, mixing, mtree, neardup, pieces, pii, quality, substrings

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_quality": quality.op3_quality,
    "op4_top_k": mtree.op4_top_k,
    "op5_pii": pii.op5_pii,
    "op6_language": langid.op6_language,
    "op7_near_duplicates": neardup.op7_near_duplicates,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_katz": katz.op9_katz,
    "op10_near_vectors": hnsw.op10_near_vectors,
}
ORACLE = {"op10_near_vectors": hnsw.OP10_SQL, "op4_top_k": mtree.OP4_SQL, "op2_substring_dedup": substrings.OP2_SQL, "op7_near_duplicates": neardup.OP7_SQL, "op8_mix_sources": mixing.OP8_SQL}
