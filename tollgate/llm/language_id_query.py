"""Query op4: languages of all documents."""

from __future__ import annotations

from tollgate.llm import language_id
from tollgate.llm.common import read_table


def op4_language_mixture(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))
