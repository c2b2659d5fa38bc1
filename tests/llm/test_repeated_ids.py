"""Rows that share an id or have none: cuts of long repeats, places of the mix, token rollups."""

from __future__ import annotations

import hashlib
import random

import pytest

from daybook.llm.mixing import mix_plan
from daybook.llm.substring_dedup import remove_repeats
from daybook.llm.token_counts import Rollup, delta, revised
from daybook.session import new_folder


def brute_cuts(rows, length=50):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - length + 1 if doc_id is not None else 0):
            piece = data[at : at + length]
            first[piece] = min(doc_id, first.get(piece, doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1 if doc_id is not None else 0):
            if first[data[at : at + length]] < doc_id:
                gone[at : at + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_ids_with_different_texts_are_cut_apart(spark):
    draw = random.Random(5)
    passage = "".join(draw.choices("abcdefgh ", k=400))
    other = "".join(draw.choices("ijklmnop ", k=480))
    rows = [(1, passage), (5, "z" * 500 + passage), (5, "tiny"), (5, other), (5, other + passage[:100]), (5, other), (None, passage), (None, "x" + passage)]
    rows += [(7, other[100:300]), (7, passage[30:200] + "q" * 60), (7, None), (7, ""), (8, "q" * 130), (9, other[:70] + passage[200:280])]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute_cuts(rows)


def test_rows_without_id_come_near_their_target(spark):
    rows = [(None, f"{n:04d} " + "word " * 39 + "x", "s0") for n in range(400)]
    rows += [(n, "word " * 40, "s1") for n in range(300)] + [(n, "word " * 40, "s2") for n in range(2000, 2900)]
    planned = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in planned.groupBy("source").agg({"mix_target": "max"}).withColumnRenamed("max(mix_target)", "target").collect():
        taken = sum(x.mix_copies * x.mix_size for x in planned.where(planned.source == r.source).collect())
        assert abs(taken - r.target) <= 41, (r.source, taken, r.target)


# ---- rollups

COUNTED = "source string, lang string, tokenizer string, tokens long"


def totals(rollup):
    return sorted(map(tuple, rollup.totals().collect()), key=repr)


@pytest.fixture
def rollup(spark):
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    rows = spark.createDataFrame([("a", "en", "t", 5), ("a", "en", "t", 10)], COUNTED)
    assert rollup.commit("one", delta(added=rows)) and rollup.commit("two", delta(added=rows.limit(1)))
    return rollup


def test_a_compaction_stopped_after_its_commit_doubles_nothing(spark, rollup, monkeypatch):
    before = totals(rollup)

    class Stopped(Exception):
        pass

    real = Rollup._files

    class NoDelete:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def delete(self, path, recursive):
            raise Stopped

    monkeypatch.setattr(Rollup, "_files", lambda self: NoDelete(real(self)))
    with pytest.raises(Stopped):
        rollup.compact("sum", ["one", "two"])
    monkeypatch.setattr(Rollup, "_files", real)
    assert totals(rollup) == before
    assert not rollup.compact("sum", ["one", "two"])  # cleans up what was left
    assert totals(rollup) == before and rollup._batches()[0] == {"sum"}
    rows = spark.createDataFrame([("a", "en", "t", 5)], COUNTED)
    assert not rollup.commit("one", delta(added=rows)) and totals(rollup) == before
    assert rollup.commit("three", delta(added=rows)) and rollup.compact("all", ["sum", "three"])
    assert not rollup.commit("two", delta(added=rows)) and not rollup.commit("sum", delta(added=rows))
    assert totals(rollup) == [("a", "en", "t", 4, before[0][4] + 5)]


def test_of_two_writers_of_a_batch_one_wins(spark, rollup, monkeypatch):
    before = totals(rollup)
    rows = spark.createDataFrame([("b", "de", "t", 7)], COUNTED)
    monkeypatch.setattr(Rollup, "committed", lambda self, batch: False)  # both looked before either one wrote
    assert not rollup.commit("one", delta(added=rows))
    assert totals(rollup) == before
    assert not any("_aside" in s.getPath().getName() for s in rollup._files().listStatus(rollup._path("batch=one")))


def test_revision_of_repeated_and_missing_ids(spark):
    schema = f"doc_id long, {COUNTED}"
    old = [(1, "a", "en", "t", 5), (1, "a", "en", "t", 5), (None, "a", "en", "t", 3), (None, "b", "en", "t", 4), (2, None, None, "t", 9)]
    new = [(1, "a", "en", "t", 5), (1, "a", "en", "t", 6), (None, "b", "en", "t", 4), (None, "a", "en", "t", 3), (2, None, None, "t", 9), (3, "a", "de", "t", 1)]
    added, removed = revised(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema))
    assert sorted(map(tuple, delta(added, removed).collect())) == [("a", "de", "t", 1, 1), ("a", "en", "t", 0, 1)]
