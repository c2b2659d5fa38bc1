from __future__ import annotations

import hashlib
import random
import re

from corpus import SCHEMA, odd_rows, sentence, vocabulary

from daybook.llm.exact_dedup import exact_groups
from daybook.llm.line_dedup import drop_near_lines, near_line_drops


def test_exact_groups_agree_with_brute_force(spark):
    draw, words = random.Random(2), vocabulary()
    texts = [sentence(draw, words, 8) for _ in range(20)]
    rows = [(i, draw.choice(texts).replace(" ", draw.choice([" ", "\n", "  "]), 1), "en", "s", None) for i in range(300)]
    rows += [(1000 + i, "the one text that a third of all rows have", "en", "s", None) for i in range(200)] + odd_rows()
    draw.shuffle(rows)
    normal = {row: re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "") for row in rows}
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(normal[row], []).append(row[0])
    expected = []
    for row in rows:
        ids = groups[normal[row]]
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(normal[row].encode()).hexdigest()
        expected.append((row[0], keep, len(ids), row[0] == keep, sha))
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "keep_id").repartition(5)
    got = exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_exact_groups_of_an_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def within_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :] or a == b


def brute_drops(rows: list[tuple], least: int, near: int) -> set[tuple]:
    lines = []
    for doc_id, text in rows:
        for place, raw in enumerate((text or "").split("\n") if text is not None else []):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", raw).strip(" ")
            if len(norm) >= least:
                lines.append(((doc_id, place), norm))

    def repeats(a: str, b: str) -> bool:
        return a == b or (min(len(a), len(b)) >= near and within_one(a, b))

    return {at for at, norm in lines if any(other < at and repeats(norm, text) for other, text in lines)}


def test_near_lines_agree_with_brute_force(spark):
    draw, words = random.Random(3), vocabulary(60)
    base = [sentence(draw, words, draw.randint(4, 9)) for _ in range(25)]

    def edited(line: str) -> str:
        kind, at = draw.randrange(5), draw.randrange(len(line))
        return [line, line, line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "y" + line[at + 1 :]][kind]

    rows = [(i, "\n".join(edited(draw.choice(base)) for _ in range(draw.randint(1, 4)))) for i in range(150)]
    rows += [(500 + i, f"a line that ends in the number {i:04d}\n\nshort") for i in range(60)]
    got = near_line_drops(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=12, near_chars=12)
    expected = brute_drops(rows, 12, 12)
    assert {(r.doc_id, r.line) for r in got.collect()} == expected
    assert len(expected) > 100


def test_short_equal_lines_and_a_hot_line_agree_with_brute_force(spark):
    draw = random.Random(4)
    short = ["}", "{", " a ", "b", "", " \t", "Item 1", "Item 2", "see also", "a line of 24 characters!", "a line of 24 characters?", "twenty-three characters", "twenty-three characterz"]
    long = [sentence(draw, vocabulary(60), 90) for _ in range(4)]
    long += [line[:50] + "#" + line[51:] for line in long] + [line[:200] + line[201:] for line in long]
    rows = [(i, "\n".join(["- - -", *(draw.choice(short + long) for _ in range(draw.randint(0, 5)))])) for i in range(120)]
    rows += [(None, "Item 1\nItem 1"), (None, None)]
    expected = brute_drops([(-1 if doc_id is None else doc_id, text) for doc_id, text in rows], 1, 24)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(-1 if r.doc_id is None else r.doc_id, r.line) for r in near_line_drops(docs).collect()}
    assert got == expected
    assert (-1, 1) in got and (-1, 0) not in got


def test_lines_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumnRenamed("n_chars", "n_lines")
    got = {(r.doc_id, r.lang): r for r in drop_near_lines(docs).collect()}
    assert (got[(900, "en")].text, got[(900, "en")].n_lines) == (None, 0)
    assert (got[(901, "en")].text, got[(901, "en")].n_lines) == ("", 1)
    assert got[(904, None)].text == "" and got[(904, None)].n_dropped == 1
    assert got[(903, "en")].n_dropped == 0
    assert drop_near_lines(spark.createDataFrame([], SCHEMA)).count() == 0
