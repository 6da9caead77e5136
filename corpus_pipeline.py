"""Training corpus in five stages: toxicity, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of ``documents``. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldscar.llm.common import broadcast_if, remove, shared_folder, table
from fieldscar.llm.decontamination import decontaminate
from fieldscar.llm.jaccard import similar_documents
from fieldscar.llm.packing import packed
from fieldscar.llm.pii import mask_texts
from fieldscar.llm.toxicity import toxicity
from fieldscar.session import configure, cut_lineage

#: doc_ids up to which a list of them is broadcast; a longer one is joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose doc_id is not among ``ids``; rows without a doc_id stay."""
    return docs.join(broadcast_if(cut_lineage(ids.distinct()), BROADCAST_IDS), "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models predict as toxic go; rows of one doc_id go together."""
    found = toxicity(docs, table(spark, sf_dir, "labels"))
    return _without(docs, found.filter("predicted = 1").select("doc_id"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays, once if its row is
    repeated (the smallest text of rows that share a doc_id)."""
    found = cut_lineage(similar_documents(docs))
    kept = _without(docs, found.filter("doc_id <> component_id").select("doc_id"))
    repeated = cut_lineage(found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"))
    once = kept.join(broadcast_if(repeated, BROADCAST_IDS), "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    first = once.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in rest if c != "text"])).alias("first"))
    return _without(kept, repeated).unionByName(first.select("doc_id", *[F.col(f"first.{c}").alias(c) for c in rest]).select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated").select("doc_id"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become [KIND]; n_chars follows the text."""
    return mask_texts(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing of all documents, one row per piece."""
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Models, tokens and packing have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again,
    and removed when its successor is written."""
    folder = shared_folder(configure(spark), "pipeline")
    docs, before = table(spark, sf_dir.rstrip("/"), "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir.rstrip("/")).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
