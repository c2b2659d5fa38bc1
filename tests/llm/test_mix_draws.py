"""Blocks of the mix in shards."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from corpus import SCHEMA, odd_rows, sentence, vocabulary
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import mixing
from daybook.llm.queries import CORPUS_QUERIES


def rows_of_sources() -> list[tuple]:
    draw, words = random.Random(9), vocabulary()
    sources = ["big"] * 6 + ["mid", "mid", "small", None]
    rows = [(i, sentence(draw, words, draw.randint(1, 40)), "en", draw.choice(sources), None) for i in range(2000)]
    return rows + [r for r in odd_rows() if r[0] != 907]


def test_blocks_of_shards_follow_the_quotas(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BITS", 4)
    docs = spark.createDataFrame(rows_of_sources(), SCHEMA).where("length(text) > 8 AND doc_id < 900")
    mixed = mixing.mix(docs, shards=5).withColumn("part", F.spark_partition_id()).collect()
    shards_of, parts = defaultdict(set), defaultdict(list)
    for r in mixed:
        shards_of[r.source, r.mix_block].add(r.mix_shard)
        parts[r.part].append((r.mix_shard, r.mix_order))
    assert all(len(shards) == 1 for shards in shards_of.values())
    sources = sorted({s for s, _ in shards_of}, key=lambda s: (s is None, s or ""))
    blocks = [len({b for s, b in shards_of if s == source}) for source in sources]
    found = Counter((source, shard) for (source, _), (shard,) in shards_of.items())
    quotas = mixing.shard_quotas(blocks, 5, 8)
    assert [[found[source, shard] for shard in range(5)] for source in sources] == quotas.tolist()
    assert len(parts) == 5 and all(len({shard for shard, _ in rows}) == 1 and rows == sorted(rows) for rows in parts.values())


def test_shards_and_blocks_follow_the_size(spark, monkeypatch):
    assert mixing.shards_of(0) == mixing.shards_of(10**9) == 64
    assert mixing.shards_of(10**13) == -(-(10**13) // mixing.SHARD_WORDS)
    assert mixing.block_bits(10**9, 10**9, 64) == 10 and mixing.block_bits(10**13, 10**13, 75_000) == 21
    assert mixing.block_bits(1, 10**13, 75_000) == mixing.block_bits(0, 0, 64) == 1
    tree = list(mixing._quota_tree([2**21] + [2] * 1000, 10_000, 3))
    assert [shard for shard, _, _ in tree] == list(range(10_000))
    sizes = [int(counts.sum()) for _, _, counts in tree]
    assert sum(sizes) == 2**21 + 2000 and max(sizes) - min(sizes) <= 2
    docs = spark.createDataFrame(rows_of_sources(), SCHEMA).where("doc_id < 900").withColumn("mix_number", F.lit("mine"))
    monkeypatch.setattr(mixing, "SHARD_WORDS", 150)
    planned, dealt, shards = mixing.planned_mix(docs)
    assert shards > 100
    copies = planned.groupBy("doc_id").agg(F.sum("mix_copies").alias("n")).where("n > 0").collect()
    mixed = mixing.drawn(planned, dealt, docs.columns, shards).collect()
    assert Counter(r.doc_id for r in mixed) == {r.doc_id: r.n for r in copies}
    owner = {(r.mix_number, r.mix_block): r.mix_shard for r in dealt.collect()}
    assert len(owner) == dealt.count()
    number = {r.mix_source: (r.mix_number, r.mix_bits) for r in planned.select("mix_source", "mix_number", "mix_bits").distinct().collect()}
    for r in mixed:
        source, bits = number[r.source]
        assert r.mix_block == (r.mix_copy << bits) + ((r.mix_place % (1 << 64)) >> (64 - bits))
        assert owner[source, r.mix_block] == r.mix_shard
    monkeypatch.setattr(mixing, "broadcast_if_small", lambda *frames: list(frames))
    again = mixing.drawn(planned, dealt, docs.columns, shards).collect()
    assert [(r.doc_id, r.mix_copy) for r in again] == [(r.doc_id, r.mix_copy) for r in mixed]


def test_query_takes_what_is_drawn(spark, tmp_path):
    spark.createDataFrame(rows_of_sources(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = CORPUS_QUERIES["op8_mix_sources"](spark, str(tmp_path)).collect()
    assert len(got) == docs.count()
    plan = mixing.mix_plan(docs).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in got) == sorted((str(r.doc_id), r.mix_size, r.mix_size * r.mix_copies) for r in plan)
    by_shard = defaultdict(list)
    for r in mixing.mix(docs).collect():
        by_shard[r.mix_shard].append((r.mix_order, r.mix_size, r.doc_id))
    for r in got:
        if r.doc_id is not None and r.doc_id < 900:
            assert all(by_shard[d.shard][d.position][2] == r.doc_id for d in r.draws)
            assert len(r.draws) * r.size == r.taken
    assert sum(len(r.draws) for r in got if r.doc_id is not None and r.doc_id < 900) == sum(
        r.mix_copies for r in plan if r.doc_id is not None and r.doc_id < 900
    )


def test_pipeline_writes_the_mix_shard_by_shard(spark, tmp_path):
    docs = spark.createDataFrame(rows_of_sources(), SCHEMA)
    stage = corpus_pipeline.mixed_sources(spark, docs, str(tmp_path)).withColumn("part", F.spark_partition_id()).collect()
    expected = mixing.mix(docs).select("mix_shard", *docs.columns).collect()
    assert [r.part for r in stage] == [r.mix_shard for r in expected]
    assert [(r.doc_id, r.text) for r in stage] == [(r.doc_id, r.text) for r in expected]
