"""A training corpus from ``documents``: language, near copies, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
``documents``. Its result is written and read again as the next one's input.

Cases: null and empty texts and texts without letters leave at the language stage; texts of any
length are worked on whole; of repeated rows one stays; an empty table passes through every stage;
extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, near_dedup, packing, repeats, secrets
from tidemark.llm.shared import documents, save

#: The share of its text that a document's largest language must have; one in four equal parts stays.
LEAST_SHARE = 0.2


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have; the rest go."""
    training = docs.where(~F.coalesce(langid.held_out(), F.lit(False)))
    found, share = (f"{'_' * max(map(len, docs.columns))}{c}" for c in ("language", "share"))  # longer than any input column
    judged = langid.identify(docs, training, docs.columns, (found, share))
    return judged.where((F.col(found) != "und") & (F.col(share) >= LEAST_SHARE)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return near_dedup.one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of long repeated strings are cut out; the first copy stays."""
    return _recounted(repeats.remove_later_copies(docs))


def hidden_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are blacked out; other text stays as it is."""
    return _recounted(secrets.redact_secrets(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces in near-equal windows."""
    return packing.pack(docs, bpe.default_tokenizer())


STAGES = [("language", language), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("hidden_secrets", hidden_secrets), ("packing", packed)]

#: SQL can express none of the models and automata here; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
