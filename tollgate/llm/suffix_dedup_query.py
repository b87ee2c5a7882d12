"""Query op1: bytes covered by repeated 400-byte strings of all documents."""

from __future__ import annotations

from tollgate.llm import suffix_dedup
from tollgate.llm.common import read_table


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
