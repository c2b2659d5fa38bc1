"""From raw documents to token files: the stages of a corpus, each a corpus operator on what the stage before kept.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns a frame that is written and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.

Rows go to Python in batches of at most ``BATCH_ROWS``, since a batch is held whole on both sides. A stage sets this for
its session, as batches are cut when its frame is written; a smaller setting of the session stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import stored, table
from daybook.llm.decontamination import benchmark_hits
from daybook.llm.jaccard_join import near_duplicates
from daybook.llm.language_id import UNKNOWN, label_languages, train
from daybook.llm.mixing import mix
from daybook.llm.token_files import read_token_files, write_token_files
from daybook.session import new_folder

LEAST_LANGUAGE_SCORE = 0.4
NEAR_WORDS, NEAR_PERCENT = 5, 80
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have the session send at most ``BATCH_ROWS`` rows to Python at a time; 0 or less means no bound."""
    now = int(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter and those in which no language has two fifths of the words; ``lang`` is what was found."""
    small_batches(spark)
    labelled = label_languages(docs, train(docs))
    kept = labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies; of rows with one id and one text, one.

    Rows without id stay, one of each text.
    """
    small_batches(spark)
    groups = near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT).where("doc_id = component_id")
    kept = groups.select(F.col("doc_id").alias("kept_id")).distinct().withColumn("is_kept", F.lit(True))
    marked = docs.join(kept, F.col("doc_id") == F.col("kept_id"), "left").where("doc_id IS NULL OR is_kept")
    same = marked.withColumn("same_text", F.xxhash64("text")).dropDuplicates(["doc_id", "same_text"])
    return same.select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more of the words are passages of the benchmark."""
    small_batches(spark)
    return benchmark_hits(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of the shards; a copy has the id of its document."""
    return mix(docs).select(docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold: ``doc_id, start, n_tokens, ids`` of each document."""
    small_batches(spark)
    folder = new_folder(spark, "tokens")
    write_token_files(docs, folder, special=True)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_languages),
    ("near_copies", one_of_near_copies),
    ("decontaminate", without_benchmarks),
    ("mix", mixed_sources),
    ("tokens", token_files),
]

#: SQL can express neither the language model nor the tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents, each written below the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
