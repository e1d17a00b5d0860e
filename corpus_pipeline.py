"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Every stage takes any rows with the columns of documents; all but the last return
these columns (and any further ones, whatever their names) unchanged but for the
texts that personal data is taken out of. An empty table gives an empty one.
Very long texts are handled whole, by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargeline.llm import decontaminate, ngram_join, packing, pii, quality
from chargeline.llm.frames import documents
from chargeline.llm.queries import TEMPER, benchmark, vocabulary
from chargeline.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands.

    Null and empty texts have no words and go. Repeated rows have one fate; a null
    id does not matter; nothing is ranked."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates.

    Texts without words, and rows without an id, stay. Rows equal in id and text
    are one document: all of them stay, or none; two of one id but different text
    are compared like others and, if in one group, both stay."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, as all do if there is no item.
    Repeated rows have one fate; a null id does not matter."""
    return decontaminate.clean(docs, benchmark(spark, sf_dir))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text.

    A null text stays null, with a null n_chars. Repeated rows are changed alike; of
    spans that overlap the first one names the kind (ties: the order of kinds)."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, sources mixed by tempered shares.

    A null text is an empty document; a null source is a source; repeated rows and
    rows without an id are packed each."""
    return packing.pack(docs, vocabulary(added=True), temper=TEMPER).drop("ids", "source")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packed)]

#: zstandard ratios, tokenizer ids and graph components are beyond DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
