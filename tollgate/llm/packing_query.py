"""Query op9: all documents packed into sequences of 2048 tokens."""

from __future__ import annotations

import public_tokenizers

from tollgate.llm import packing
from tollgate.llm.common import read_table


def op9_best_two_fit(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
