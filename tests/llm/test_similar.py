from __future__ import annotations

import hashlib
import random

import pytest
from corpus import SCHEMA, family, odd_rows, sentence, vocabulary

from daybook.llm import jaccard_join
from daybook.llm.components import components
from daybook.llm.substring_dedup import remove_repeats


def root(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_components(rows: list[tuple], size: int, percent: int) -> dict:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for doc_id, text, *_ in rows:
        w = (text or "").translate(lower).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    parent = {i: i for i in sets}
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(parent, a), root(parent, b)))
                parent[rb] = ra
    return {i: (len(s), root(parent, i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "percent", "frequent", "all_pairs"), [(4, 85, 8, 200), (4, 85, 3, 2), (5, 80, 10**6, 3)])
def test_near_duplicates_agree_with_brute_force(spark, monkeypatch, size, percent, frequent, all_pairs):
    """With the usual bounds, and with bounds that send nearly all buckets through hubs and token pairs."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "ALL_PAIRS", all_pairs)
    draw, words = random.Random(4), vocabulary()
    rows = family(draw, words, 0, 70, 90, 5) + family(draw, words, 100, 40, 500, 30) + family(draw, words, 200, 20, 12, 1)
    rows += [(300 + i, sentence(draw, words, draw.randint(0, 6)), "en", "s", None) for i in range(60)]
    shared = sentence(draw, words, 40)
    rows += [(400 + i, f"{sentence(draw, words, 10)} {shared} {sentence(draw, words, 3)}", "en", "s", None) for i in range(40)]
    draw.shuffle(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows, size, percent)


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumnRenamed("source", "component_id")
    got = jaccard_join.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].n_shingles == by_id[902].n_shingles == 0 and by_id[901].component_id == 901
    assert by_id[904].component_id == 903
    assert by_id[None].component_id is None
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 501 + i) for i in range(80)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {501 + i: 500 for i in range(80)}


def brute_removed(rows: list[tuple], length: int) -> list[tuple]:
    first: dict[bytes, int] = {}
    texts = [(doc_id, (text or "").encode()) for doc_id, text, *_ in rows]
    for doc_id, data in texts:
        for at in range(len(data) - length + 1):
            if doc_id is not None:
                part = data[at : at + length]
                first[part] = min(first.get(part, doc_id), doc_id)
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if doc_id is not None and first[data[at : at + length]] < doc_id:
                gone[at : at + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_removed_repeats_agree_with_brute_force(spark):
    draw, words = random.Random(5), vocabulary()
    passages = [sentence(draw, words, 30) for _ in range(4)]
    rows = family(draw, words, 0, 25, 60, 4)
    for i in range(80):
        start = draw.randrange(40)
        passage = draw.choice(passages)[start : start + draw.randint(30, 140)]
        rows.append((100 + i, f"{sentence(draw, words, 6)}{passage}{sentence(draw, words, 6)}", "en", "s", None))
    rows += [(300 + i, "ab" * 60 + "c" * i, "en", "s", None) for i in range(5)] + odd_rows()
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "n_spans").repartition(4)
    got = remove_repeats(docs, with_text=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(brute_removed(rows, 50), key=repr)
    for r in got:
        if "�" not in r.kept_text:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
