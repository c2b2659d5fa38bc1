"""What Python workers of the pipeline hold: batches of few rows, and nothing that is free once a partition is done."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from daybook.llm import common, decontamination, jaccard_join, language_id, token_files

TEXT = "one two three four five six seven eight"


def batch(**columns):
    return pa.RecordBatch.from_pydict(columns)


SCANS = {
    "language": (
        lambda: language_id._label(SimpleNamespace(value=language_id.fit([TEXT], ["en"])), "text", False),
        batch(doc_id=[1], text=[TEXT]),
    ),
    "shingles": (lambda: jaccard_join._sums(5), batch(doc_id=[1], text=[TEXT])),
    "benchmark": (lambda: decontamination._match_batches(SimpleNamespace(value=(["a"], [TEXT])), 13, 5, "text"), batch(doc_id=[1], text=[TEXT])),
    "checksums": (
        lambda: token_files._checksums,
        pa.RecordBatch.from_arrays(
            [pa.array([1]), pa.array([0]), pa.array([2]), pa.array([[5, 2]], pa.list_(pa.int32()))], ["doc_id", "start", "n_tokens", "ids"]
        ),
    ),
}


@pytest.mark.parametrize("name", SCANS)
def test_scans_give_memory_back_when_their_partition_is_done(monkeypatch, name):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(name))
    make, one = SCANS[name]
    found = make()(iter([one, one]))
    assert next(found).num_rows
    assert not given
    assert list(found) is not None
    assert given == [name]


def test_freed_memory_goes_back_to_the_system():
    """Arrays of 64 kB stand below the size from which the C library asks the system for each by itself."""

    def resident() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    def scan(batches):
        held = [np.ones(8192) for _ in range(4000)]
        yield from batches
        last.append(held[-1])  # it stands at the top of what was asked for, so nothing below is given back by itself

    last: list[np.ndarray] = []
    common.give_back()
    before = resident()
    assert list(common.giving_back(scan)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 50 << 20


@pytest.mark.parametrize(("set_to", "used"), [("10000", "1000"), ("0", "1000"), ("200", "200")])
def test_stages_send_few_rows_at_a_time(spark, set_to, used):
    docs = spark.createDataFrame([(1, TEXT, "a", "en")], "doc_id long, text string, source string, lang string")
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    spark.conf.set(corpus_pipeline.BATCH_SETTING, set_to)
    try:
        corpus_pipeline.identify_languages(spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == used
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
