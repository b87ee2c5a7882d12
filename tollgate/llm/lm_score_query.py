"""Query op2: language-model scores of all documents."""

from __future__ import annotations

from tollgate.llm import lm_score
from tollgate.llm.common import read_table


def op2_lm_score(spark, sf_dir):
    return lm_score.score(read_table(spark, sf_dir, "documents"))
