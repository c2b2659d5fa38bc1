"""Exact deduplication by a distributed sort of the content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import BLANK, stored, table
from daybook.llm.registry import query

HEAD_CHARS = 32
_RUNS = "doc_id long, text_sha256 string, keep_id long, group_size long, task int, at_start boolean, at_end boolean"


def normalised(text: str = "text") -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[{BLANK}]+", " ")


def _mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each text of a sorted partition with the one before it; number, size and first id of each run.

    Of an open run only the ids are held; a partition holds a bounded share of any group.
    """
    task = TaskContext.get().partitionId()
    unknown = np.iinfo(np.int64).max
    ids, nulls = np.zeros(0, np.int64), np.zeros(0, bool)
    digests = pa.array([], pa.string())
    text: pa.Scalar | None = None
    begun = False

    def runs(starts: np.ndarray, at_end: bool) -> pa.RecordBatch:
        """The rows held, which are whole runs that begin at ``starts``."""
        nonlocal begun
        sizes = np.diff(np.append(starts, len(ids)))
        keep = np.minimum.reduceat(np.where(nulls, unknown, ids), starts)
        at_start = np.repeat(np.arange(len(starts)) == (-1 if begun else 0), sizes)
        begun = True
        keep, size = np.repeat(keep, sizes), np.repeat(sizes, sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=nulls),
                digests,
                pa.array(keep, pa.int64(), mask=keep == unknown),
                pa.array(size),
                pa.array(np.full(len(ids), task, np.int32)),
                pa.array(at_start),
                pa.array(np.full(len(ids), at_end)),
            ],
            ["doc_id", "text_sha256", "keep_id", "group_size", "task", "at_start", "at_end"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("norm")
        new = np.ones(batch.num_rows, bool)
        new[0] = text is None or text != column[0]
        new[1:] = ~pc.equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new) + len(ids)
        if len(ids) and not (len(starts) and starts[0] == 0):
            starts = np.append(0, starts)
        raw = batch.column("doc_id")
        ids = np.append(ids, pc.fill_null(raw, 0).to_numpy())
        nulls = np.append(nulls, raw.is_null().to_numpy(zero_copy_only=False))
        digests = pa.concat_arrays([digests, batch.column("sha")])
        text = column[len(column) - 1]
        open_from = int(starts[-1])
        if open_from:
            rest = ids[open_from:], nulls[open_from:], digests.slice(open_from)
            ids, nulls, digests = ids[:open_from], nulls[:open_from], digests.slice(0, open_from)
            yield runs(starts[:-1], False)
            ids, nulls, digests = rest
    if len(ids):
        yield runs(np.zeros(1, np.int64), True)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when the normalised texts are; NULL counts as empty. The smallest id of a group stays; of rows that
    repeat that id all are kept. A row without id is never the one that stays, unless its whole group has none: then
    ``keep_id`` is NULL and all its rows are kept.

    Sampled splitters deal the texts to ranges of (first characters, digest, id), so that the sample stays small however
    long the texts are, and a group of any size spreads over as many ranges as it fills. Each range is sorted (Spark
    spills), equal texts become neighbours and are compared in full. Runs that touch the edge of a range are joined from
    one row per range, which is all that the driver sees.
    """
    spark = docs.sparkSession
    norm = docs.select(F.col(id_column).cast("long").alias("doc_id"), normalised(text).alias("norm"))
    keyed = norm.select("doc_id", "norm", F.sha2("norm", 256).alias("sha"), F.substring("norm", 1, HEAD_CHARS).alias("head"))
    ordered = keyed.repartitionByRange("head", "sha", "doc_id").sortWithinPartitions("head", "sha", "norm", "doc_id")
    runs = stored(ordered.select("doc_id", "norm", "sha").mapInArrow(_mark_runs, _RUNS), "runs")
    edges = (
        runs.where("at_start OR at_end")
        .groupBy("task", "at_start", "at_end", "text_sha256", "group_size")
        .agg(F.min("keep_id").alias("keep_id"))
        .collect()
    )
    whole: dict[str, list] = {}
    for row in edges:
        ids, size = whole.setdefault(row.text_sha256, [[], 0])
        ids.extend([] if row.keep_id is None else [row.keep_id])
        whole[row.text_sha256][1] = size + row.group_size
    rows = [(row.task, row.at_start, row.at_end, min(whole[row.text_sha256][0], default=None), whole[row.text_sha256][1]) for row in edges]
    fixes = spark.createDataFrame(rows, "task int, at_start boolean, at_end boolean, whole_keep long, whole_size long")
    joined = runs.join(F.broadcast(fixes), ["task", "at_start", "at_end"], "left")
    edge = F.col("whole_size").isNotNull()
    keep = F.when(edge, F.col("whole_keep")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.when(edge, F.col("whole_size")).otherwise(F.col("group_size")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


@query(f"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[{BLANK}]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
