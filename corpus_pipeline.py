"""From raw documents to packed training sequences, in five stages.

Every stage takes what the one before has kept and written. A stage that changes texts brings
``n_chars`` up to date; all but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm import lines, minhash, packing, pii, quality
from burstline.llm.queries import tokenizer
from burstline.llm.storage import Scratch, unused
from burstline.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(documents: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; 0 for null."""
    if "n_chars" not in documents.columns:
        return documents
    kind = documents.schema["n_chars"].dataType
    length = F.coalesce(F.length("text"), F.lit(0)).cast(kind)
    return documents.withColumn("n_chars", length)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is too low; empty and null texts are scored too.
    Held-out labels stay unseen, as in the query."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out())
    (score,) = unused(docs.columns, "_score")
    scored = quality.with_score(docs, quality.fit(docs, labels), score)
    return scored.filter(F.col(score) >= quality.KEEP_FROM).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that five or more documents hold. Documents stay, null texts as null."""
    (null,) = unused(docs.columns, "_null")
    marked = docs.withColumn(null, F.col("text").isNull())
    # Results that are named like columns of the input are not wanted here.
    own = {c: unused(docs.columns, c)[0] for c in docs.columns if c in ("n_lines", "n_dropped")}
    kept = lines.dedup_lines(marked.withColumnsRenamed(own), min_documents=5, min_chars=40)
    kept = kept.drop(*own).withColumnsRenamed({v: k for k, v in own.items()})
    text = F.when(~F.col(null), F.col("text"))
    return _counted(kept.withColumn("text", text)).select(docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies. Rows without id stay; rows that share an
    id stay or go together."""
    groups = minhash.near_duplicates(docs, percent=75, words=5)
    gone = groups.filter(~F.col("kept")).select("doc_id").distinct()
    scratch = Scratch(spark, "pipeline-near-copies")
    return docs.join(scratch.store(gone, "gone"), "doc_id", "left_anti").select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return _counted(pii.redact(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("near-copy dedup", dedup_documents),
    ("personal data", redact),
    ("packing", pack),
]

# Scores, hashes and tokens have no SQL form; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
