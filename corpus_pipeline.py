"""The corpus pipeline: five operators, one after the other, over documents.

``STAGES`` names the stages in order.  Each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every
stage's result as Parquet into the shared checkpoint folder and reads it back
as the next one's documents.  All stages but the last return the columns of
the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import bpe, crf, decontam, secrets, simhash
from fareflow.llm.common import free_name, prepare, read, saved
from fareflow.llm.queries import tokenizer_file

# Documents with this toxicity score or more are rejected: those op3 predicts toxic.
REJECT = crf.TOXIC


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that the chain scores as toxic."""
    prepare(spark)
    model = crf.learn(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "toxicity_score")
    marked = crf.tag(docs, model, score=score, spans=free_name(docs, "toxic_spans"))
    return marked.where(F.col(score) < REJECT).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the least id stays.

    Rows that repeat the id of a kept document are dropped as well.  A row
    without an id cannot be named as the one to keep or drop, so it stays.
    The join and the dropping of repeated ids share one exchange.
    """
    prepare(spark)
    kept = simhash.near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents into which a benchmark item leaked."""
    prepare(spark)
    leaks = decontam.matches(docs, read(spark, sf_dir, "benchmark"))
    name = free_name(docs, "leaked_id")
    leaked = saved(leaks.select(F.col("doc_id").alias(name)).distinct(), "leaked")
    if leaked.limit(decontam.BROADCAST_IDS + 1).count() <= decontam.BROADCAST_IDS:
        leaked = F.broadcast(leaked)  # counted ids of 8 bytes each
    return docs.join(leaked, F.col("doc_id").cast("long") == F.col(name), "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret found by a mark; the documents stay."""
    prepare(spark)
    names, spans = docs.columns, free_name(docs, "found_spans")
    found = secrets.scan(docs, spans=spans)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in names:
        clean = clean.withColumn("n_chars", F.when(
            F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    prepare(spark)
    ranks, pattern = tokenizer_file()
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), ranks, pattern)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "exact")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

# The chain, the groups and the ids have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
