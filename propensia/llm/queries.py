"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from propensia.llm import (
    chosen_path,
    cover_tree,
    dataset_manifest,
    merkle,
    packing,
    pitman_yor,
    sentencepiece_dropout,
    sharding,
    token_slots,
    toxicity,
    warc,
    weak_supervision,
    whitening,
)

QUERIES = {
    "op1_sharding": sharding.query,
    "op2_token_slots": token_slots.query,
    "op3_merkle": merkle.query,
    "op4_chosen_path": chosen_path.query,
    "op5_warc": warc.query,
    "op6_toxicity": toxicity.query,
    "op7_sentencepiece": sentencepiece_dropout.query,
    "op8_packing": packing.query,
    "op9_pitman_yor": pitman_yor.query,
    "op10_weak_supervision": weak_supervision.query,
    "op11_cover_tree": cover_tree.query,
    "op12_dataset_manifest": dataset_manifest.query,
    "op13_whitening": whitening.query,
}

ORACLE: dict[str, str] = {
    "op3_merkle": merkle.ORACLE_SQL,
    "op5_warc": warc.ORACLE_SQL,
    "op10_weak_supervision": weak_supervision.ORACLE_SQL,
    "op12_dataset_manifest": dataset_manifest.ORACLE_SQL,
}
