"""Mixing, token counts, the pipeline and the registered queries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import SCHEMA, odd_rows, sentence, vocabulary
from tokenizers import Tokenizer

import corpus_pipeline
from daybook.llm import mixing
from daybook.llm.common import table
from daybook.llm.queries import CORPUS_ORACLES, CORPUS_QUERIES
from daybook.llm.token_counts import Rollup, counted, delta, revised
from daybook.llm.token_files import tokenizer_path
from daybook.session import new_folder

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets():
    got = mixing.targets({"b": 100, "a": 10, "c": 1000, None: 5})
    # a weighs 5, b 2, c 1, None 5 again; a and None stop at three times their size
    assert got["a"] == 30 and got[None] == 15 and got["b"] == 300 and got["c"] == pytest.approx(770)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}
    assert sum(mixing.targets({"x": 7, "y": 9}).values()) == pytest.approx(16)


def test_shard_quotas_are_exact():
    quotas = mixing.shard_quotas([700, 41, 0, 3], 8, 1)
    assert quotas.sum(axis=1).tolist() == [700, 41, 0, 3] and set(quotas.sum(axis=0)) == {93}
    assert (mixing.shard_quotas([700, 41, 0, 3], 8, 1) == quotas).all()


def test_mix_comes_near_its_targets(spark):
    draw, words = random.Random(7), vocabulary()
    sources = ["big"] * 6 + ["mid", "mid", "small", None]
    rows = [(i, sentence(draw, words, draw.randint(1, 40)), "en", draw.choice(sources), None) for i in range(2000)] + odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "mix_size")
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += len(WORD.findall(row[1] or ""))
    expected = mixing.targets(dict(sizes))
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    taken = defaultdict(int)
    for r in plan:
        assert r.mix_size == len(WORD.findall(r.text or "")) and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(expected[r.source]) and r.mix_size * r.mix_copies <= 3 * r.mix_size
        taken[r.source] += r.mix_size * r.mix_copies
    longest = {s: max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - expected[s]) <= longest[s] for s in sizes)
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan))
    mixed = mixing.mix(docs, shards=4).collect()
    assert len(mixed) == sum(r.mix_copies for r in plan) and {r.mix_shard for r in mixed} <= set(range(4))
    assert mixing.mix_plan(docs.limit(0)).count() == 0


def test_counts_and_rollup(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "tokens")
    counts = counted(docs)
    expected, number = Counter(), Counter()
    for _, text, lang, source, _ in rows:
        expected[source, lang] += len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        number[source, lang] += 1
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit("a", delta(added=counts)) and not rollup.commit("a", delta(added=counts))

    def totals() -> dict:
        return {(r.source, r.lang): (r.documents, r.tokens) for r in rollup.totals().collect()}

    whole = {key: (number[key], expected[key]) for key in number}
    assert totals() == whole
    gone = counts.where("source = 's0'")
    rollup.commit("b", delta(removed=gone))
    rollup.commit("b", delta(removed=gone))
    assert totals() == {key: value for key, value in whole.items() if key[0] != "s0"}
    rollup.commit("c", delta(added=gone))
    assert totals() == whole
    unique = spark.createDataFrame([r for r in rows if r[0] in (901, 903, 906)], SCHEMA)
    before, after = counted(unique), counted(unique.withColumn("lang", unique["source"]))
    added, removed = revised(before, after)
    assert added.count() == removed.count() == 3
    rollup.commit("d", delta(added, removed))
    assert sum(n for n, _ in totals().values()) == len(rows) and totals()["s1", "s1"][0] == 1
    now = totals()
    assert rollup.compact("all", ["a", "b", "c", "d"]) and totals() == now
    assert delta(added=counts.limit(0)).count() == 0


def test_pipeline_stages_keep_their_contract(spark, tmp_path):
    docs = table(spark, SMALL, "documents").unionByName(spark.createDataFrame(odd_rows(), SCHEMA))
    columns, seen = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "decontaminate", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        folder = f"file://{tmp_path}/{name}"
        stage(spark, docs, SMALL).write.parquet(folder)
        before, docs = docs, spark.read.parquet(folder)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids and ids <= seen
        if name != "tokens":
            assert docs.columns == columns
        if name == "language":
            assert not ids & {900, 901, 902, 905} and len(ids) > 0.97 * len(seen)
        if name == "near_copies":
            assert docs.where("doc_id IN (903, 904)").count() == 1
            assert docs.select("text").distinct().count() == docs.count() < before.count()
        if name == "tokens":
            assert docs.count() == before.count()
        seen = ids
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name


NATIVE = ["op1_line_dedup", "op8_mix_sources"]


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in CORPUS_QUERIES) == list(range(1, 14))
    assert set(CORPUS_ORACLES) == {name for name in CORPUS_QUERIES if re.match("op([1235]|12)_", name)}


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python(spark, name):
    plan = CORPUS_QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("name", sorted(CORPUS_ORACLES))
def test_queries_agree_with_sql(spark, name):
    from check_oracles import compare, database

    assert compare(CORPUS_QUERIES[name](spark, SMALL), database(SMALL), CORPUS_ORACLES[name]) == ""


OTHER_ROWS = {"op10_token_counts", "op11_conversation_repair"}


@pytest.mark.parametrize("name", sorted(set(CORPUS_QUERIES) - set(CORPUS_ORACLES) - OTHER_ROWS))
def test_queries_have_a_row_for_each_document(spark, name):
    rows = CORPUS_QUERIES[name](spark, SMALL).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, SMALL, "documents").select("doc_id").collect())


def test_repair_query_has_a_row_for_each_conversation(spark):
    rows = CORPUS_QUERIES["op11_conversation_repair"](spark, SMALL).select("conv_id").collect()
    known = table(spark, SMALL, "conversations").select("conv_id").distinct().collect()
    assert sorted(r.conv_id for r in rows) == sorted(r.conv_id for r in known)


def test_token_count_query_counts_every_document(spark):
    rows = CORPUS_QUERIES["op10_token_counts"](spark, SMALL).collect()
    docs = table(spark, SMALL, "documents").collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert sum(r.documents for r in rows) == len(docs)
    assert sum(r.tokens for r in rows) == sum(len(tokenizer.encode(d.text or "", add_special_tokens=False).ids) for d in docs)
    assert np.all([r.documents > 0 for r in rows])
