"""Decontamination, token files, language, quality."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from corpus import SCHEMA, odd_rows, sentence, vocabulary
from tokenizers import Tokenizer

from daybook.llm import language_id, quality
from daybook.llm.common import table
from daybook.llm.decontamination import benchmark_hits
from daybook.llm.token_files import read_token_files, tokenizer_path, write_token_files
from daybook.session import new_folder

SMALL = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_hits(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    benchmark = [(item_id, cut.findall(text.translate(LOWER))) for item_id, text in items if item_id is not None and text]
    out = []
    for doc_id, text, *_ in rows:
        w = cut.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item_id, v in benchmark:
            size = min(13, len(v))
            for j in range(len(v) - size + 1 if size else 0):
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == v[j : j + size]:
                        hit.update(range(i, i + size))
                        found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_hits_agree_with_brute_force(spark, limit):
    draw, words = random.Random(6), vocabulary(80)
    items = [(i, sentence(draw, words, draw.randint(1, 30))) for i in range(25)]
    items += [(25, items[20][1]), (None, "x y z"), (26, None), (27, ""), (28, "!!!"), (29, " ".join(["the"] * 20))]
    rows = odd_rows()[:-1]
    for i in range(60):
        piece = draw.choice(items[:26])[1].split(" ")
        part = piece[draw.randrange(len(piece)) :]
        rows.append((i, f"{sentence(draw, words, draw.randint(0, 60))}, {' '.join(part).upper()} {sentence(draw, words, 4)}", "en", "s", None))
    rows.append((70, " ".join(["the"] * 30), "en", "s", None))
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "n_hit")
    got = benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    values = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got.collect()]
    assert sorted(values, key=repr) == brute_hits(rows, items)
    assert any(v[4] for v in values) and "text" in got.columns
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(docs, nothing, limit=limit).where("n_hit > 0").count() == 0
    assert benchmark_hits(docs.limit(0), nothing, limit=limit).count() == 0


def test_token_files_hold_what_the_tokenizer_gives(spark):
    rows = odd_rows() + [(i, text, "en", "s", None) for i, text in enumerate(
        ["I'll  see\n\n it's 10 o'clock", "  two\t tabs  end ", "é" * 50, "x²½ ª º", "a b　c", "\x1c\x1d odd", "don't'S"])]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    folder = new_folder(spark, "tokens")
    write_token_files(spark.createDataFrame(rows, SCHEMA).repartition(3), folder)
    got = read_token_files(spark, folder).orderBy("start").collect()
    expected = sorted(
        ((r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows),
        key=lambda x: (x[0] is not None, x[0] or 0),
    )
    assert [r.doc_id for r in got] == [i for i, _ in expected]
    assert sorted((r.doc_id, r.ids) for r in got if r.doc_id is not None) == sorted(x for x in expected if x[0] is not None)
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    empty = new_folder(spark, "tokens")
    write_token_files(spark.createDataFrame([], SCHEMA), empty)
    assert read_token_files(spark, empty).count() == 0


def test_language_of_held_out_documents(spark):
    docs = table(spark, SMALL, "documents")
    model = language_id.train(docs)
    rows = language_id.label_languages(docs.select("doc_id", "text", "lang"), model).collect()
    fold = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in fold]) > 0.97
    odd = spark.createDataFrame(odd_rows(), SCHEMA).withColumnRenamed("source", "lang_pred")
    got = {r.doc_id: r for r in language_id.label_languages(odd, model, with_runs=True).collect()}
    assert {got[i].lang_pred for i in (900, 901, 902, 905)} == {"und"} and got[900].lang_score == 0
    assert got[906].lang_pred in model.languages and 0 <= got[906].lang_score <= 1
    texts = {r.lang: r.text for r in rows if r.lang == r.lang_pred and r.text and len(r.text) > 400}
    both = spark.createDataFrame([(1, texts["fr"][:300] + " " + texts["de"][:300])], "doc_id long, text string")
    runs = [r.lang for r in language_id.label_languages(both, model, with_runs=True).first().lang_runs if r.words > 5]
    assert runs == ["fr", "de"]


def test_language_without_anything_to_learn(spark):
    model = language_id.train(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in language_id.label_languages(spark.createDataFrame(odd_rows(), SCHEMA), model).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = quality.train(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.score_quality(docs.select("doc_id", "text"), model).collect()
    fold = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id in known]
    assert np.mean([r.quality_pred == known[r.doc_id] for r in fold]) > 0.9
    odd = spark.createDataFrame(odd_rows(), SCHEMA).withColumnRenamed("source", "quality_score")
    got = quality.score_quality(odd, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.quality_score <= 1 for r in got)
    none = quality.train(docs, labels.limit(0))
    assert {r.quality_score for r in quality.score_quality(odd, none).collect()} == {0.5}
    assert quality.score_quality(odd.limit(0), model).count() == 0
