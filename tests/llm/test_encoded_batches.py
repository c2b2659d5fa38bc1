"""Texts of a batch are cut and encoded together."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from daybook.llm import token_files

LATIN = ["'", "s", "t", "m", "d", "r", "v", "l", "e", " ", "  ", "\n", "\t", "\xa0", "\r", "a", "Z", "é", "ß", "ɏ", "1", "²", "!", "ª", "'re", "'ll"]
ODD = ["中", "<|endoftext|>", "\x0b", "\x00", "𝔸", "̀", "\x85", "я"]


class Counting:
    def __init__(self, model: object) -> None:
        self.model, self.seen = model, []

    def tokenize(self, piece: str) -> list:
        self.seen.append(piece)
        return self.model.tokenize(piece)


class NoTask:
    @staticmethod
    def get() -> type[NoTask]:
        return NoTask

    @staticmethod
    def partitionId() -> int:
        return 0


def batch(texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def encoded(texts: list) -> list[list[int]]:
    scan = token_files._encode_partition(token_files.tokenizer_path(), 2, True)
    return [ids for part in scan(iter([batch(texts)])) for ids in part.column("ids").to_pylist()]


def test_a_piece_is_encoded_once_for_all_texts_of_a_batch(monkeypatch):
    """However few pieces a worker keeps."""
    encoder = token_files.encoder(token_files.tokenizer_path(), True)
    model = Counting(encoder.model)
    monkeypatch.setattr(encoder, "model", model)
    monkeypatch.setattr(token_files, "TaskContext", NoTask)
    monkeypatch.setattr(token_files, "CACHED_PIECES", 2)
    texts = [" one two three four five", " six seven eight nine ten"] * 15
    assert len(set(map(tuple, encoded(texts)))) == 2
    assert len(model.seen) == len(set(model.seen)) == 10


def test_texts_of_a_batch_have_the_ids_of_the_tokenizer(monkeypatch):
    monkeypatch.setattr(token_files, "TaskContext", NoTask)
    monkeypatch.setattr(token_files, "CHUNK_BYTES", 64)
    plain = token_files.encoder(token_files.tokenizer_path(), True).tokenizer
    draw = random.Random(7)
    for letters in [LATIN] * 20 + [LATIN + ODD] * 10:
        texts = [draw.choice([None, "", "".join(draw.choices(letters, k=draw.choice([1, 2, 3, 5, 9, 40])))]) for _ in range(40)]
        expected = [[*plain.encode(text or "", add_special_tokens=False).ids, 2] for text in texts]
        assert encoded(texts) == expected


def test_a_slice_of_a_batch_and_no_rows():
    encoder = token_files.encoder(token_files.tokenizer_path(), True)
    texts = pa.array(["skipped", "a b", None, "c"])
    ids, sizes = encoder.encoded(texts.slice(1))
    assert sizes.tolist() == [2, 0, 1]
    assert ids.tolist() == np.concatenate([encoder.tokenizer.encode(x).ids for x in ("a b", "c")]).tolist()
    assert [len(x) for x in encoder.encoded(texts.slice(4))] == [0, 0]
