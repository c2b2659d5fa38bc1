"""Posteriors of words against sums over whole paths, and learning from long texts and rare languages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA

from daybook.llm import language_id
from daybook.llm.common import text_bytes, words


def plain_posteriors(score: np.ndarray, model: language_id.Model) -> tuple[np.ndarray, np.ndarray]:
    """One text, word after word, in logarithms."""
    n, kinds = score.shape
    forward, backward = np.zeros((n, kinds)), np.zeros((n, kinds))
    forward[0] = model.start + score[0]
    for t in range(1, n):
        forward[t] = np.logaddexp.reduce(forward[t - 1][:, None] + model.transitions, axis=0) + score[t]
    for t in range(n - 2, -1, -1):
        backward[t] = np.logaddexp.reduce(model.transitions + score[t + 1] + backward[t + 1], axis=1)
    total = np.logaddexp.reduce(forward[-1])
    moves = np.zeros((kinds, kinds))
    for t in range(1, n):
        moves += np.exp(forward[t - 1][:, None] + model.transitions + score[t] + backward[t] - total)
    return np.exp(forward + backward - total), moves


@pytest.mark.parametrize(("block", "group"), [(512, 256), (7, 3), (1, 2)])
def test_posteriors_are_sums_over_paths_of_whole_texts(monkeypatch, block, group):
    monkeypatch.setattr(language_id, "BLOCK", block)
    monkeypatch.setattr(language_id, "GROUP", group)
    draw = np.random.default_rng(5)
    lengths = [3, 0, 1, 40, 2_600 if block == 512 else 90, 7, 8, 14]
    text = text_bytes(pa.array([" ".join(["w"] * n) for n in lengths]))
    found = words(*text, language_id.LETTER_BYTES)
    kinds = 3
    score = draw.normal(0, 1.5, (sum(lengths), kinds))
    score[20:35, 0] += 400
    model = language_id.Model(list("abc"), None, None, draw.normal(0, 1, (kinds, kinds)) + 4 * np.eye(kinds), draw.normal(0, 1, kinds))
    posterior, moves = language_id.forward_backward(score, found, model, with_moves=True)
    low, expected_moves = 0, np.zeros((kinds, kinds))
    for n in lengths:
        if n:
            expected, more = plain_posteriors(score[low : low + n], model)
            assert np.allclose(posterior[low : low + n], expected, atol=1e-9)
            expected_moves += more
        low += n
    assert np.allclose(moves, expected_moves, rtol=1e-7, atol=1e-7)


def test_scores_do_not_depend_on_slices(monkeypatch):
    column = pa.array(["one two three vier fünf", "", None, "x" * 500 + " sechs"])
    found = language_id.features(column, np.zeros(0, np.uint64))
    weights = np.random.default_rng(6).normal(0, 1, (language_id.GRAMS + 2 * language_id.AFFIXES + language_id.LEXICON + 1, 2)).astype(np.float32)
    whole = language_id.emissions(found, weights)
    monkeypatch.setattr(language_id, "SLICE", 9)
    assert np.allclose(language_id.emissions(found, weights), whole, atol=1e-4)


def test_long_texts_and_rare_languages_are_learned(spark):
    long = " ".join(["ngiyabonga kakhulu mngane wami", "sawubona unjani namhlanje"] * 800)
    rows = [(i, f"the weather of day {i} was fine and they went out for a walk", "en", "s", None) for i in range(200)]
    rows += [(1000 + i, long + f" usuku {i}", "zu", "s", None) for i in range(8)]
    rows += [(2000 + i, f"kot{i} i pies poszli razem przez zielony las do domu", f"rare{i % 2}", "s", None) for i in range(8)]
    model = language_id.train(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["en", "rare0", "rare1", "zu"]
    ask = [(1, "sawubona mngane wami", None, None, None), (2, "they were fine", None, None, None), (3, long, None, None, None)]
    got = {r.doc_id: r.lang_pred for r in language_id.label_languages(spark.createDataFrame(ask, SCHEMA), model).collect()}
    assert got == {1: "zu", 2: "en", 3: "zu"}


def test_pieces_without_ids_are_bounded(spark):
    rows = [(None, "the same text without an id", "en", "s", None)] * 500 + [(1, "un autre texte", "fr", "s", None)]
    model = language_id.train(spark.createDataFrame(rows, SCHEMA), per_language=5)
    assert set(model.languages) <= {"en", "fr"}
