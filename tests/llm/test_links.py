"""Links of near copies."""

from __future__ import annotations

import random

import pytest
from corpus import SCHEMA, family, sentence, vocabulary

from daybook.llm import jaccard_join


def brute_links(rows: list[tuple], size: int, percent: int) -> dict:
    sets = {}
    for doc_id, text, *_ in rows:
        w = text.split()
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    linked = {i: [j for j in sets if j != i and x and 100 * len(x & sets[j]) >= percent * len(x | sets[j])] for i, x in sets.items()}
    first = {i: min([j for j in sets if sets[j] == x]) if x else i for i, x in sets.items()}
    return {i: (len(linked[i]), first[i]) for i in sets}


@pytest.mark.parametrize(("frequent", "all_pairs", "combined"), [(8, 100, 16), (3, 2, 2), (10**6, 3, 2)])
def test_every_link_is_counted(spark, monkeypatch, frequent, all_pairs, combined):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "ALL_PAIRS", all_pairs)
    monkeypatch.setattr(jaccard_join, "COMBINED_PAIRS", combined)
    draw, words = random.Random(11), vocabulary()
    rows = family(draw, words, 0, 130, 90, 3) + family(draw, words, 200, 40, 500, 30) + family(draw, words, 300, 20, 12, 1)
    rows += [(400 + i, sentence(draw, words, draw.randint(0, 4)), "en", "s", None) for i in range(60)]
    draw.shuffle(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), with_links=True)
    expected = brute_links(rows, 4, 85)
    assert {r.doc_id: (r.n_links, r.class_id) for r in got.collect()} == expected
    assert max(n for n, _ in expected.values()) > 60
