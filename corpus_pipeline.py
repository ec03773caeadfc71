"""Corpus pipeline: documents become token sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows and reads them back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import benchmark_leaks, page_language, page_overlap, site_lines, token_packing
from matchloom.llm.queries import VOCABULARY, hash_rest
from matchloom.session import Workspace, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NAMES = {"doc_id": "match_id", "text": "page_text", "lang": "language", "source": "site"}


def to_pages(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS).withColumnsRenamed(NAMES)


def to_documents(pages: DataFrame) -> DataFrame:
    return pages.withColumnsRenamed({new: old for old, new in NAMES.items()}).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known main language go; others stay as they are."""
    tune(spark, CONF)
    pages = to_pages(docs)
    model = page_language.fit_languages(pages.where(hash_rest("match_id", 5) != 0))
    return to_documents(page_language.keep_known_languages(pages, model))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source leave its documents."""
    tune(spark, CONF)
    cleaned = site_lines.drop_site_lines(to_pages(docs), Workspace(spark, "lines"), keep=("site", "language", "n_chars"))
    changed = F.col("n_dropped") > 0
    return to_documents(cleaned.withColumn(
        "n_chars", F.when(changed, F.length("page_text").cast("long")).otherwise(F.col("n_chars"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the smallest id stays."""
    tune(spark, CONF)
    return to_documents(page_overlap.keep_first_pages(to_pages(docs), Workspace(spark, "overlap"), words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go."""
    tune(spark, CONF)
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.col("text").alias("passage"))
    return to_documents(benchmark_leaks.drop_leaks(to_pages(docs), passages))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of each document's ids."""
    tune(spark, CONF)
    pieces = token_packing.pack_pages(to_pages(docs), public_tokenizers.path(VOCABULARY))
    return pieces.select(F.col("match_id").alias("doc_id"), "start", "length", F.crc32("token_ids").alias("ids_crc32"),
                         F.col("page_tokens").alias("doc_tokens"), "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Python workers and the JVM hold a batch of texts or sets on either side, besides what the stages before left them.
CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

# Edit distances and tokenizer ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table of ``sf_dir``."""
    work = Workspace(tune(spark, CONF), "pipeline")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = work.settle(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
