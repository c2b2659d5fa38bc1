"""Repeats found slice by slice: the same results, and nothing large left on disk."""

from __future__ import annotations

import os
import random

import pytest
from corpus import SCHEMA, family, odd_rows, sentence, vocabulary
from test_similar import brute_removed

from daybook import session
from daybook.llm import substring_dedup
from daybook.llm.substring_dedup import remove_repeats


def rows_with_repeats():
    draw, words = random.Random(11), vocabulary()
    passages = [sentence(draw, words, 30) for _ in range(4)]
    rows = family(draw, words, 0, 20, 60, 4)
    for i in range(50):
        start = draw.randrange(40)
        passage = draw.choice(passages)[start : start + draw.randint(30, 140)]
        rows.append((100 + i, f"{sentence(draw, words, 6)}{passage}{sentence(draw, words, 6)}", "en", "s", None))
    return rows + [(300 + i, "ab" * 60 + "c" * i, "en", "s", None) for i in range(5)] + odd_rows()


@pytest.fixture
def folder(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda _: f"file://{tmp_path}")
    return tmp_path


@pytest.mark.parametrize(("slices", "parts", "crowded"), [(3, 1, 1 << 24), (2, 3, 0)])
def test_slices_and_parts_change_no_result(spark, monkeypatch, slices, parts, crowded):
    rows, asked = rows_with_repeats(), []

    def gone(listing, length, number):
        asked.append(number)
        return original(listing, length, parts)

    original = substring_dedup._gone
    monkeypatch.setattr(substring_dedup, "_gone", gone)
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 1)
    monkeypatch.setattr(substring_dedup, "MOST_SLICES", slices)
    monkeypatch.setattr(substring_dedup, "CROWDED_GRAMS", crowded)
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(brute_removed(rows, 50), key=repr)
    assert asked == [1]


def test_strings_to_list_come_in_parts_if_there_are_many(spark, monkeypatch):
    rows, asked = rows_with_repeats(), []
    original = substring_dedup._gone
    monkeypatch.setattr(substring_dedup, "_gone", lambda listing, length, parts: asked.append(parts) or original(listing, length, 2))
    monkeypatch.setattr(substring_dedup, "LISTED_STRINGS", 100)
    monkeypatch.setattr(substring_dedup, "LISTED_SHARE", 1 << 30)
    remove_repeats(spark.createDataFrame(rows, SCHEMA)).count()
    assert asked[0] > 2


def test_large_tables_are_deleted_once_they_were_used(spark, folder):
    """Contexts and their sums stayed on disk to the end, beside all shuffles."""
    rows = rows_with_repeats()
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(brute_removed(rows, 50), key=repr)
    assert {name.rpartition("-")[0] for name in os.listdir(folder)} == {"several-texts", "spans", "gone-windows"}
