"""Query op8: unigram token counts of all documents."""

from __future__ import annotations

import public_tokenizers

from tollgate.llm import token_count
from tollgate.llm.common import read_table


def op8_count_viterbi(spark, sf_dir):
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
