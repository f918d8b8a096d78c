"""Registered queries of the operators and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from . import bpe, byte_bpe, embeddings, exact_dedup, hard_negatives, langid, licenses, minhash, mixing, secret_scan, spelling, token_counts, warc

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_warc_round_trip": warc.op2_warc_round_trip,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_minhash_near_dedup": minhash.op4_minhash_near_dedup,
    "op5_embedding_near_dedup": embeddings.op5_embedding_near_dedup,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_bpe_round_trip": bpe.op7_bpe_round_trip,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_language_id": langid.op10_language_id,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_byte_bpe_round_trip": byte_bpe.op12_byte_bpe_round_trip,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE = {
    "op2_warc_round_trip": warc.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op8_secret_scan": secret_scan.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
}
