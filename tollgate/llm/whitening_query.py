"""Query op13: all vectors of ``embeddings`` on their first four components."""

from __future__ import annotations

from tollgate.llm import whitening
from tollgate.llm.common import read_table


def op13_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), scale=256.0, components=4)
