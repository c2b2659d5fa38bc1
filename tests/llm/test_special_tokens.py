"""Names of special tokens inside texts."""

from __future__ import annotations

import zlib

import numpy as np
from corpus import SCHEMA, odd_rows
from tokenizers import Tokenizer

import corpus_pipeline
from daybook.llm.queries import CORPUS_QUERIES
from daybook.llm.token_files import tokenizer_path


def test_queries_encode_special_tokens_as_the_file_says(spark, tmp_path):
    texts = ["a b <|endoftext|> c", "<|endoftext|>", "x<|endoftext|><|endoftext|> é", "<|endoftext", "plain text"]
    rows = [r for r in odd_rows() if r[0] in (901, 903, 905, 906)]
    rows += [(i, text, "en", "s", None) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(tokenizer_path())
    plain = {r[0]: tokenizer.encode(r[1], add_special_tokens=False).ids for r in sorted(rows)}
    assert plain[0] == [64, 275, 220, 50256, 269]
    expected = {i: [*ids, 2] for i, ids in plain.items()}
    sums = {i: zlib.crc32(np.array(ids, "<u4")) for i, ids in expected.items()}
    starts = dict(zip(expected, np.cumsum([0, *map(len, expected.values())]).tolist()))
    got = CORPUS_QUERIES["op4_token_output"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == {
        i: (starts[i], len(expected[i]), sums[i]) for i in expected
    }
    totals = CORPUS_QUERIES["op10_token_counts"](spark, str(tmp_path)).collect()
    assert sum(r.tokens for r in totals) == sum(map(len, plain.values()))
    stage = corpus_pipeline.token_files(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id: r.ids for r in stage.collect()} == expected
