"""Query op7: quality scores of all documents."""

from __future__ import annotations

from tollgate.llm import quality_classifier
from tollgate.llm.common import read_table


def op7_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)
