"""Query op10: fingerprints and components over all documents."""

from __future__ import annotations

from tollgate.llm import simhash
from tollgate.llm.common import read_table


def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
