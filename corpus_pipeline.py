"""Training-data pipeline over ``documents``: each stage works on all that the one before it kept.

    quality      documents that the compression classifier rejects go (none where the labels allow no model)
    lines        lines that an earlier line is similar to go (a document may be left without lines)
    near copies  of each group of SimHash near-duplicates the document of the smallest id stays
    mixing       documents repeat, or go, as the source weights ask
    packing      the texts' tokens in sequences of 1024; one row per piece

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows the text.  Null texts
count as empty, and stay null until packing.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenaria.llm import quality
from scenaria.llm.common import find_package, read_table, written
from scenaria.llm.linededup import dedup_lines
from scenaria.llm.mixing import mixed_documents, word_count
from scenaria.llm.packing import pack, pieces
from scenaria.llm.simhash import keep_first


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_package(spark)
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs, "doc_id", "text", threshold=0.8)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_package(spark)
    return keep_first(docs, "doc_id", "text", shingle=3)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, "doc_id", word_count("text"), F.array("source"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_package(spark)
    return pack(pieces(docs, "doc_id", "text"))


STAGES = [("quality_classifier", good_quality), ("line_dedup", distinct_lines), ("simhash_near_dedup", one_of_each),
          ("source_mixing", mixed_sources), ("best_fit_packing", packed)]
#: DuckDB SQL cannot express trained scores, hash fingerprints or token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i + 1}-{name}")
    return docs
