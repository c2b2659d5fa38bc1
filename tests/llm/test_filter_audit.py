"""The filter audit against counting every document for every order."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

from corpus import SCHEMA, odd_rows, sentence, vocabulary

from daybook.llm import filter_audit as audit

LABELS = "doc_id long, quality int, toxic int"


def masks_of(rows):
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        yield doc_id, source or "", fails + "E" * (doc_id is not None and smallest[text] < doc_id)


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    by_part = defaultdict(list)
    for doc_id, part, fails in masks_of(rows):
        by_part[part].append((doc_id, fails))
    out = {}
    for part, docs in by_part.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            there = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in there if name in d[1]]
                there = [d for d in there if name not in d[1]]
                shapley[name] += len(gone)
                failing = [d for d in docs if name in d[1]]
                out[part, order, step] = [len(there), len(gone), len(failing) - len(gone), sum(d[1] == name for d in docs),
                                          sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), name]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {key: tuple(row) for key, row in out.items()}


def told(df):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in df.collect()}


def test_audit_agrees_with_counting(spark):
    draw, words = random.Random(8), vocabulary(300)
    rows = odd_rows()
    for i in range(150):
        text = sentence(draw, words[: draw.choice([8, 300])], draw.choice([3, 49, 50, 80])).strip()
        text = draw.choice([text, text.upper(), text + " 5%", rows[-1][1]])
        rows.append((draw.choice([i, i, i, 7]), text, "en", draw.choice(["s0", "s0", "", None, "s3"]), None))
    labels = [(i, draw.randint(0, 1), draw.randint(0, 1)) for i in range(0, 160, 2)] + [(7, 0, 0), (7, 1, None), (None, 1, 1), (8, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS mask", "'x' AS part", "0 AS n", "1 AS good", "'d' AS digest")
    frame = spark.createDataFrame(labels, LABELS).selectExpr("*", "'t' AS text")
    assert told(audit.filter_interactions(docs.repartition(4), frame)) == brute(rows, labels)


def test_nothing_to_audit(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert audit.filter_interactions(docs, labels).count() == 0
    alone = told(audit.filter_interactions(spark.createDataFrame([(1, None, None, None, None)], SCHEMA), labels))
    assert len(alone) == 600 and alone["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_exchanges_reach_every_order_once():
    for size in range(6):
        order, seen = list(range(size)), set()
        seen.add(tuple(order))
        for level in audit.neighbouring_exchanges(size):
            order[level : level + 2] = order[level + 1], order[level]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(size))))


def test_swaps_keep_the_counts_of_a_diagram():
    draw = random.Random(9)
    masks = {m: (draw.randint(0, 3), 0, draw.randint(0, 1)) for m in range(32)}
    diagram = audit.Diagram("ABCDE", masks)
    before, steps = diagram.total(0, diagram.root), list(diagram.steps())
    for level in (0, 3, 2, 2, 3, 0):
        diagram.swap(level)
        assert diagram.total(0, diagram.root) == before
    assert "".join(diagram.order) == "ABCDE" and list(diagram.steps()) == steps
