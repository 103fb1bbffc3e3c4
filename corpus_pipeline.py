"""Corpus pipeline: documents in, token ids of the cleaned documents out.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.llm.bpe import vocabulary
from voltaria.llm.encode import encode
from voltaria.llm.jaccard import jaccard_join
from voltaria.llm.langid import held_out, learn, predict
from voltaria.llm.paragraphs import deduplicated, row_id
from voltaria.llm.ship import ship
from voltaria.llm.tiling import contaminated
from voltaria.session import scratch_path, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL has neither zstandard nor a tokenizer.
ORACLE_SQL: str | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go; lang becomes the predicted language."""
    ship(spark)
    model = learn(docs.where(~held_out("doc_id")))
    own = {c: _fresh(c, docs) for c in ("lang_pred", "score", "rejected") if c in docs.columns}  # columns that the classifier names alike
    named = predict(docs.withColumnsRenamed(own), model).where("not rejected")
    return named.select(*(F.col("lang_pred" if c == "lang" else own.get(c, f"`{c}`")).alias(c) for c in docs.columns))


def _fresh(name: str, docs: DataFrame) -> str:
    """A column name that the documents do not have."""
    name = f"own_{name}"
    return name if name not in docs.columns else _fresh(name, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group stays, the one of the smallest id. Rows without an id stay; of repeated rows of
    one id and text, one."""
    ship(spark)
    kept = stage(jaccard_join(docs).where("doc_id = component_id").select("doc_id").distinct(), "kept")
    chosen = docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))
    repeats = not docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty()
    return chosen.dropDuplicates(["doc_id", "text"]) if repeats else chosen


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs and passages that an earlier document holds go from the text; emptied documents go."""
    ship(spark)
    return deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, told apart by a hash of id and text."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    row = _fresh("row", docs)
    rows = docs.withColumn(row, row_id("doc_id", "text"))
    held = contaminated(rows.select(F.col(row).alias("doc_id"), "text"), items).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(held, row, "left_anti").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    ship(spark)
    return encode(docs, vocabulary(), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("BPE encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, apply in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
