"""What scans hold at a time, and how often the token encoder looks a piece up."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import substring_dedup, token_files

LENGTH = substring_dedup.LENGTH


def test_scans_of_repeats_hold_little_of_a_task():
    """24 million bytes have some 1.5 million anchors, and all arrays of half a megabyte of text were held."""
    letters = np.random.default_rng(1).integers(97, 123, (240, 100_000), np.uint8)
    texts = pa.array([line.tobytes().decode() for line in letters])
    batch = pa.RecordBatch.from_arrays([pa.array(range(240)), pa.nulls(240, pa.int64()), texts], names=["doc_id", "text_key", "text"])
    next(substring_dedup._grams(LENGTH)(iter([batch.slice(0, 2)])))  # tables that stay
    tracemalloc.start()
    grams = sum(found.num_rows for found in substring_dedup._grams(LENGTH)(iter([batch])))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert grams > 1_000_000
    assert most < 60 << 20, most


class Counting(dict):
    looked = 0

    def get(self, key, default=None):
        Counting.looked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        Counting.looked += 1
        return super().__getitem__(key)

    def __contains__(self, key):
        Counting.looked += 1
        return super().__contains__(key)


@pytest.mark.parametrize("cached", [3, 200_000])
def test_pieces_are_looked_up_once(monkeypatch, cached):
    monkeypatch.setattr(token_files, "CACHED_PIECES", cached)
    encoder = token_files.Encoder(token_files.tokenizer_path(), True)
    encoder.known = Counting()
    plain = encoder.tokenizer
    for text in ["one two one  two", "", "two three\n don't 12.5% one", " ".join(f"new{i} one two" for i in range(200))]:
        pieces = token_files._latin()[1](text)
        Counting.looked = 0
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert cached == 3 or Counting.looked <= len(pieces) + 2 * len(set(pieces))
