"""The corpus pipeline: four stages from raw documents to packed sequences.

1. quality classifier: documents that importance resampling does not draw go.
2. quality rules: documents that the rules reject go.
3. near duplicates: one document of each class of near copies stays.
4. packing: the documents left are cut and packed into sequences.

Each stage works on all that the one before it kept, is written as Parquet in
the shared folder and read again as the next one's documents; what a stage
landed on its way is removed then.  The first three return the columns of
``documents``.

Defined cases: null and empty texts are too short for the rules and go there;
of repeated rows one stays at the third stage; a null id is an id of its own
and comes last where the smallest names a class; extra columns stay up to
the packing, under any name; an empty table gives no sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leafstat.llm import dsir, llr_rules, lsh_forest, packing
from leafstat.llm.common import documents, landed, landed_so_far, release, ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    sampler, _ = dsir.resample(docs, documents(spark, sf_dir, "labels"))
    return dsir.drawn(docs, sampler)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    return llr_rules.kept(docs, trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return lsh_forest.representatives(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality classifier", quality_classifier), ("quality rules", quality_rules),
          ("near duplicates", near_duplicates), ("best-fit packing", best_fit_packing)]

#: Hashed n-grams, noise and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        mark = landed_so_far()
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
