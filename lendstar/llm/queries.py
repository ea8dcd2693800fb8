"""Queries of this package by name, and their DuckDB SQL where SQL can say them."""

from __future__ import annotations

from lendstar.llm import (
    bpe, countmin, embeddings, fingerprints, langid, licenses, linededup, minhash, orchard, packing, prefixtrie, suffixes,
    warc,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_warc": warc.op2_warc,
    "op3_pack": packing.op3_pack,
    "op4_bpe_roundtrip": bpe.op4_bpe_roundtrip,
    "op5_line_dedup": linededup.op5_line_dedup,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_minhash": minhash.op7_minhash,
    "op8_fingerprint": fingerprints.op8_fingerprint,
    "op9_embeddings": embeddings.op9_embeddings,
    "op10_language": langid.op10_language,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_orchard": orchard.op12_orchard,
    "op13_substring_dedup": countmin.op13_substring_dedup,
    "pages_language": langid.pages_language,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.op1_sql(),
    "op5_line_dedup": linededup.op5_sql(),
    "op8_fingerprint": fingerprints.op8_sql(),
    "op11_prefix_trie": prefixtrie.op11_sql(),
    "op12_orchard": orchard.op12_sql(),
    "op13_substring_dedup": countmin.op13_sql(),
}
