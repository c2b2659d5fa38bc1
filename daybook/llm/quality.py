"""Quality scores by votes of labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import LOWER_ASCII, WORD_BYTES, chunks, table, text_bytes, words
from daybook.llm.registry import query
from daybook.llm.sampling import bounded_per_class, held_out

FIT_PER_CLASS = 1500
SHAPES = 1024
TERMS = 1024
RATIOS = 3 * 16
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.7

_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[0x61:0x7B] = 0x61
_CLASS[0x41:0x5B] = 0x41
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x80:] = 0x61


@dataclass
class Model:
    """Weights of terms, their projection, and the unit vectors, labels and weights of the labelled documents."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


def term_counts(column: pa.Array) -> np.ndarray:
    """Hashed counts for each row: runs of three byte classes (letter case, digits, signs), words, and steps of ratios.

    The ratios are repeated words, words equal to the one before, and letters in upper case.
    """
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    kind = _CLASS[data]
    gram = np.zeros(max(0, len(data) - 2), np.uint32)
    if len(gram):
        gram = (kind[:-2] * np.uint32(0x9E3779B1)) ^ (kind[1:-1] * np.uint32(0x85EBCA6B)) ^ (kind[2:] * np.uint32(0xC2B2AE35))
        gram = (gram >> np.uint32(15)) % np.uint32(SHAPES)
    whole = row[: len(gram)] == row[2:] if len(gram) else np.zeros(0, bool)
    shapes = np.bincount((row[: len(gram)] * SHAPES + gram)[whole], minlength=rows * SHAPES).reshape(rows, SHAPES)
    text = words(LOWER_ASCII[data], offsets, WORD_BYTES)
    terms = np.bincount(text.row * TERMS + (text.hash % np.uint64(TERMS)).astype(np.int64), minlength=rows * TERMS)
    order = np.lexsort((text.hash, text.row))
    seen, seen_row = text.hash[order], text.row[order]
    again = np.bincount(seen_row[1:][(seen[1:] == seen[:-1]) & (seen_row[1:] == seen_row[:-1])], minlength=rows)
    twice = np.bincount(
        text.row[1:][(text.hash[1:] == text.hash[:-1]) & (text.row[1:] == text.row[:-1])], minlength=rows
    )
    upper = np.bincount(row[kind == 0x41], minlength=rows)
    letters = np.bincount(row[(kind == 0x61) | (kind == 0x41)], minlength=rows)
    steps = np.zeros((rows, 3, RATIOS // 3))
    for place, (part, of) in enumerate(((again, text.counts), (twice, text.counts), (upper, letters))):
        step = np.minimum((part / np.maximum(of, 1) * (RATIOS // 3)).astype(np.int64), RATIOS // 3 - 1)
        steps[np.arange(rows), place, step] = np.maximum(text.counts, 1) / 8
    return np.concatenate([shapes, terms.reshape(rows, TERMS), steps.reshape(rows, RATIOS)], axis=1).astype(np.float32)


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped shares of terms times the rarity of each term."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return _unit(np.sqrt(counts / total) * idf)


def fit(counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Latent-semantic space of the labelled documents: leading singular vectors of their weighted term counts."""
    size = counts.shape[1]
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.3
    terms = weighted(counts, idf).astype(np.float64)
    _, vectors = np.linalg.eigh(terms.T @ terms if len(terms) else np.eye(size))
    projection = vectors[:, ::-1][:, :dimensions].astype(np.float32)
    return Model(idf.astype(np.float32), projection, _unit(terms.astype(np.float32) @ projection), labels, weights)


def score(model: Model, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled documents, each weighted by a power of its cosine.

    Without labelled documents every score is 0.5.
    """
    if not len(model.labels):
        return np.full(len(counts), 0.5)
    cosine = _unit(weighted(counts, model.idf) @ model.projection) @ model.vectors.T
    count = min(neighbours, cosine.shape[1])
    near = np.argpartition(-cosine, count - 1, axis=1)[:, :count]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3).astype(np.float64) ** SHARPNESS * model.weights[near]
    return (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            counts = term_counts(part.column("text"))
            rows = pa.array([row.tobytes() for row in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("label"), rows], ["label", "counts"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    per_class: int = FIT_PER_CLASS,
) -> Model:
    """A model from a bounded sample of labelled rows outside the held-out fold.

    About ``per_class`` rows of each label are taken by a hash of the id; a vote counts as many rows as it stands for.
    Whole texts are turned into term counts on the executors, and the driver gets these counts alone.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.min("label").alias("label"))
    sample, sizes = bounded_per_class(known, "label", "doc_id", per_class, 2)
    found = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = found.select("label", "text").mapInArrow(_count_batches, "label int, counts binary").limit(8 * per_class).collect()
    width = SHAPES + TERMS + RATIOS
    counts = np.frombuffer(b"".join(bytes(row.counts) for row in rows), np.float32).reshape(len(rows), width)
    marks = np.array([row.label for row in rows], np.float64)
    drawn = {value: max(1, int((marks == value).sum())) for value in sizes}
    weights = np.array([sizes[row.label] / drawn[row.label] for row in rows])
    return fit(counts, marks, weights)


def _score_batches(shared: object, text: str, threshold: float) -> Callable:
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                scores = np.clip(score(shared.value, term_counts(part.column(text))), 0.0, 1.0)
                names = [name for name in part.schema.names if name != text]
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    [*names, "quality_score", "quality_pred"],
                )

    return apply


def score_quality(
    docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep_text: bool = True
) -> DataFrame:
    """The documents with ``quality_score`` (0 to 1) and ``quality_pred`` (1 from ``threshold`` on).

    The vectors of the labelled documents, whose number is bounded, go to every task; each whole text is compared with
    all of them, a block of documents at a time. NULL counts as the empty text, which is scored like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("quality_score", "quality_pred")
    kept = [field for field in plain.schema.fields if keep_text or field.name != text]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    renamed = plain.withColumn("score_text", F.col(text))
    return (renamed if keep_text else renamed.drop(text)).mapInArrow(
        _score_batches(shared, "score_text", threshold), f"{schema}, quality_score double, quality_pred int"
    )


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    scored = score_quality(narrow, model, keep_text=False)
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"), F.col("quality_pred").alias("predicted"))
