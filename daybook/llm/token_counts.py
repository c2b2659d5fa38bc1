"""Token totals by source, language and tokenizer version, kept up to date by signed deltas."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import chunks, stored, table
from daybook.llm.registry import query
from daybook.llm.token_files import TOKENIZER, encoder, tokenizer_path
from daybook.session import new_folder

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["documents", "tokens"]
#: The file of a compacted batch that names what it replaces.
REPLACES = "_replaces.json"
_DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def _count_batches(path: str, special: bool) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "count_text"):
                names = [name for name in part.schema.names if name != "count_text"]
                tokens = [len(encoder(path, special).ids(text or "")) // 4 for text in part.column("count_text").to_pylist()]
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.array(tokens, np.int64))], [*names, "tokens"])
        encoder(path, special).known.clear()

    return count


def counted(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text", special: bool = False) -> DataFrame:
    """The documents without their text, with ``tokens`` of the whole text (NULL: 0) and ``tokenizer``, the version.

    With ``special`` names of special tokens inside a text count as those tokens, without as ordinary text.
    """
    plain = docs.drop("tokens", "tokenizer").withColumn("count_text", F.col(text)).drop(text)
    kept = [field for field in plain.schema.fields if field.name != "count_text"]
    schema = ", ".join([*(f"`{field.name}` {field.dataType.simpleString()}" for field in kept), "tokens long"])
    return plain.mapInArrow(_count_batches(tokenizer_path(tokenizer), special), schema).withColumn("tokenizer", F.lit(tokenizer))


def delta(added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Signed totals of one batch: ``added`` rows count up, ``removed`` rows count down, a revision is both.

    Rows have ``source, lang, tokenizer, tokens``; NULL keys are groups of their own. Sums are partial before the
    shuffle, so a source with a third of all rows costs one row per task. Groups that cancel out are left out.
    """
    signed = None
    for rows, sign in ((added, 1), (removed, -1)):
        if rows is not None:
            part = rows.select(*KEYS, F.lit(sign).cast("long").alias("documents"), (F.col("tokens") * sign).alias("tokens"))
            signed = part if signed is None else signed.union(part)
    if signed is None:
        raise ValueError("a batch adds or removes rows")
    summed = signed.groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in MEASURES))
    return summed.where("documents <> 0 OR tokens <> 0")


def revised(before: DataFrame, after: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Of two counts of documents the rows to add and to remove: what only one of them has, each row as often as it does.

    Nothing is joined: equal rows (id, keys and tokens) are counted on both sides and cancel out, so repeated ids and
    rows without id are rows like any other. A document that only one side has was added or removed.
    """
    columns = [*KEYS, "tokens"]
    old, new = before.select(id_column, *columns), after.select(id_column, *columns)
    return new.exceptAll(old).select(*columns), old.exceptAll(new).select(*columns)


class Rollup:
    """Totals in a shared folder as one folder of deltas per batch.

    A batch is written aside and then renamed to the folder of its id. The rename is the commit: a batch whose folder is
    there is not applied again, a batch that failed half way has left nothing that readers see, and of two writers of
    one batch one wins: a rename to a folder that is there lands inside of it, which the loser sees and undoes, and
    readers don't look at names that begin with an underscore. Batches are additive, so they may come in any order.

    A compacted batch names the batches that it replaces. Readers leave those out from its commit on, whether they have
    been deleted or not, and their ids stay known: they are not applied again.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _batches(self) -> tuple[set[str], dict[str, list[str]]]:
        """The batches that have a folder, and what each compacted one replaces."""
        files = self._files()
        listed = files.listStatus(self._path()) if files.exists(self._path()) else []
        names = {s.getPath().getName() for s in listed if s.isDirectory()}
        there = {name.removeprefix("batch=") for name in names if name.startswith("batch=")}
        replaced = {}
        for name in there:
            if files.exists(self._path(f"batch={name}", REPLACES)):
                stream = files.open(self._path(f"batch={name}", REPLACES))
                replaced[name] = json.loads(bytes(stream.readAllBytes()).decode())
                stream.close()
        return there, replaced

    def committed(self, batch: str) -> bool:
        """Whether a batch counts already, on its own or in one that replaces it."""
        there, replaced = self._batches()
        return batch in there or any(batch in of for of in replaced.values())

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Apply a batch of deltas once; False if it was applied before."""
        return self._commit(batch, rows, None)

    def _commit(self, batch: str, rows: DataFrame, replaces: list[str] | None) -> bool:
        if self.committed(batch):
            return False
        files, aside = self._files(), f"_aside-{uuid.uuid4().hex}"
        rows.select(*KEYS, *MEASURES).write.parquet(f"{self.folder}/{aside}")
        if replaces is not None:
            stream = files.create(self._path(aside, REPLACES), False)
            stream.write(bytearray(json.dumps(replaces), "utf-8"))
            stream.close()
        won = not self.committed(batch) and files.rename(self._path(aside), self._path(f"batch={batch}"))
        if won and files.exists(self._path(f"batch={batch}", aside)):  # the other writer was first
            files.delete(self._path(f"batch={batch}", aside), True)
            return False
        if not won:
            files.delete(self._path(aside), True)
        return bool(won)

    def compact(self, batch: str, of: list[str]) -> bool:
        """Fold committed batches into one, in a single commit; False when there was nothing left to fold.

        The folders of the folded batches are deleted afterwards. A call that was stopped before that has lost nothing,
        and the same call again deletes what is left. Readers that began before the commit must not be at work then.
        """
        there, replaced = self._batches()
        again = batch in there
        if not again:
            gone = [old for name in of for old in replaced.get(name, [])]
            hidden = {name for names in replaced.values() for name in names}
            rows = self._read([name for name in of if name in there and name not in hidden])
            deltas = rows.groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in MEASURES))
            if not self._commit(batch, deltas, sorted({*of, *gone})):
                return False
        elif set(of) - set(replaced.get(batch, [])):
            return False  # a batch of this name holds something else
        for name in of:
            self._files().delete(self._path(f"batch={name}"), True)
        return not again

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], f"{_DELTA}, batch string")
        folders = [f"{self.folder}/batch={name}" for name in sorted(names)]
        return self.spark.read.option("basePath", self.folder).schema(f"{_DELTA}, batch string").parquet(*folders)

    def deltas(self) -> DataFrame:
        """All committed deltas with their ``batch``; empty before the first commit."""
        there, replaced = self._batches()
        return self._read(list(there - {name for names in replaced.values() for name in names}))

    def totals(self) -> DataFrame:
        """Documents and tokens of each source, language and tokenizer version that has any."""
        summed = self.deltas().groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in MEASURES))
        return summed.where("documents <> 0 OR tokens <> 0")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents after four batches, one of them sent twice.

    The first counts every document without its source and language, the second moves every document that has them to
    its own group; the third takes out the later copies of equal texts, and the fourth puts them back.
    """
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", "source", "lang", "text", F.xxhash64("text").alias("text_hash"))
    counts = stored(counted(texts, special=True), "counts")
    bare = counts.withColumns({name: F.lit(None).cast("string") for name in ("source", "lang")})
    first = counts.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))
    copies = counts.join(first, "text_hash").where("doc_id > first_id")
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    placed = counts.where("source IS NOT NULL OR lang IS NOT NULL")
    rollup.commit("load", delta(added=bare))
    unplaced = placed.withColumns({name: F.lit(None).cast("string") for name in ("source", "lang")})
    rollup.commit("place", delta(added=placed, removed=unplaced))
    rollup.commit("without-copies", delta(removed=copies))
    rollup.commit("without-copies", delta(removed=copies))
    rollup.commit("with-copies", delta(added=copies))
    return rollup.totals()
