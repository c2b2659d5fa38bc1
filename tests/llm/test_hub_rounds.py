"""Components among the members of stars, round by round."""

from __future__ import annotations

import random

import pytest
from corpus import SCHEMA, family, sentence, vocabulary
from test_similar import brute_components

from daybook.llm import jaccard_join


def around_a_stranger(draw: random.Random) -> list[tuple]:
    """Texts that share a passage with the text of the least id, most of them near copies of others, some in chains."""
    words = vocabulary()
    passage = sentence(draw, words, 60)
    rows = [(0, f"{passage} {sentence(draw, words, 30)}", "en", "s", None)]
    for first, members in ((100, 60), (200, 30), (300, 3)):
        own = family(draw, words, first, members, 30, 2)
        rows += [(doc_id, f"{passage} {text}", *rest) for doc_id, text, *rest in own]
    chain = sentence(draw, words, 90).split()
    for link in range(40):
        chain = list(chain)
        chain[draw.randrange(90)] = f"step{link}"
        rows.append((400 + link, " ".join(chain), "en", "s", None))
    rows += [(500 + i, f"{passage} {sentence(draw, words, 25)}", "en", "s", None) for i in range(30)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("listed", "rounds", "frequent"), [(1, 1, 10**6), (1, 3, 10**6), (2, 8, 3), (16, 6, 8)])
def test_rounds_of_hubs_agree_with_brute_force(spark, monkeypatch, listed, rounds, frequent):
    """With any number of rounds, the last of which lists what is left."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "ALL_PAIRS", 2)
    monkeypatch.setattr(jaccard_join, "HUB_OTHERS", listed)
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", rounds)
    rows = around_a_stranger(random.Random(21))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows, 4, 85)


def test_a_large_family_around_a_stranger_is_not_listed_in_pairs(spark, monkeypatch):
    """The family, whose members link with each other, has 180,000 pairs. Families at the edge of linking need more rounds and candidates."""
    candidates = []
    between = jaccard_join._between_components

    def counted(*args):
        pairs = between(*args).cache()
        candidates.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard_join, "_between_components", counted)
    draw, words = random.Random(5), vocabulary()
    passage = sentence(draw, words, 60)
    rows = [(0, f"{passage} {sentence(draw, words, 30)}", "en", "s", None)]
    rows += [(doc_id, f"{passage} {text}", *rest) for doc_id, text, *rest in family(draw, words, 100, 600, 30, 1)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: c for i, (_, c) in brute_components(rows, 4, 85).items()}
    assert sum(candidates) < 40 * len(rows)


def test_a_family_at_the_edge_of_linking_is_listed_around_few_hubs(spark, monkeypatch):
    """Nearly every member has a place in the stars of several hubs; their differences are listed about once."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    listed = []
    tokens = jaccard_join._hub_tokens

    def counted(member):
        listed.append(member.selectExpr("sum(size(differ))").first()[0] or 0)
        return tokens(member)

    monkeypatch.setattr(jaccard_join, "_hub_tokens", counted)
    draw, words = random.Random(8), vocabulary()
    base = sentence(draw, words, 150).split()
    rows = []
    for doc_id in range(400):
        text = list(base)
        for _ in range(draw.randint(1, 7)):
            text[draw.randrange(150)] = f"w{draw.randrange(10**6)}"
        rows.append((doc_id, " ".join(text), "en", "s", None))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    expected = brute_components(rows, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected
    assert len({c for _, c in expected.values()}) > 1
    assert 0 < sum(listed) < 40 * len(rows)
