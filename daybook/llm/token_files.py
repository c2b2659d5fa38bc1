"""Token ids of whole texts, written as Parquet lists that can be read by column, row group and page."""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm.common import CHUNK_BYTES, chunks, giving_back, ragged_ranges, table, text_bytes
from daybook.llm.registry import query
from daybook.session import new_folder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
CACHED_PIECES = 200_000
ENCODED_BYTES = 16 << 20
SPELLED_PIECES = 1000
BLOCK_PIECES = 1 << 17
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
_STORED = "doc_id long, part int, row long, start_in_part long, n_tokens long, ids array<int>"


def _letters(kind: str) -> str:
    return "".join(chr(c) for c in range(0xA0, 0x250) if unicodedata.category(chr(c))[0] == kind)


@cache
def _latin() -> tuple[Callable, Callable]:
    """For texts in Latin letters alone: a test, and the cut into the pieces that a byte-level BPE encodes one by one."""
    letter, digit, space = "A-Za-z" + _letters("L"), "0-9" + _letters("N"), "\t\n\r \xa0"
    cut = (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )
    return re.compile("[\t\n\r -~\xa0-ɏ]*").fullmatch, re.compile(cut).findall


_LETTER, _DIGIT, _SPACE, _OTHER, _FOREIGN = range(5)


@cache
def _kinds() -> np.ndarray:
    """What each letter that :func:`_latin` takes is to the cut, by code point; all others are foreign."""
    kinds = np.full(0x251, _FOREIGN, np.uint8)
    kinds[[*range(0x21, 0x7F), *range(0xA0, 0x250)]] = _OTHER
    kinds[[ord(c) for c in "\t\n\r \xa0"]] = _SPACE
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), *map(ord, _letters("L"))]] = _LETTER
    kinds[[*range(0x30, 0x3A), *map(ord, _letters("N"))]] = _DIGIT
    return kinds


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and code point of each letter of UTF-8 bytes; code points of more than two bytes are all 0x250."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    two = np.flatnonzero(code >= 0x80)
    second = data[np.minimum(at[two] + 1, len(data) - 1)]
    code[two] = np.where(code[two] < 0xE0, (code[two] & 0x1F) << 6 | second & 0x3F, 0x250)
    return at, np.minimum(code, 0x250)


def _cuts(code: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks the letters at which a piece begins, as the expression of :func:`_latin` cuts. ``first`` marks where texts begin."""
    last = np.append(first[1:], True)
    space = kind == _SPACE
    begins = np.append(True, kind[1:] != kind[:-1])
    # of several blanks the last one goes with what follows, if it is a space, or stands alone
    inner = space & ~first & ~last
    inner[1:] &= space[:-1]
    inner[:-1] &= ~space[1:]
    begins |= inner
    begins[1:] &= space[1:] | (code[:-1] != 0x20)
    begins |= first
    # 's 't 'm 'd 're 've 'll, where the apostrophe begins a piece
    quote = np.flatnonzero((code == 0x27) & begins & ~last)
    next_one = code[quote + 1]
    for letters in ("s", "t", "m", "d", "re", "ve", "ll"):
        found = quote[next_one == ord(letters[0])]
        if len(letters) == 2:
            found = found[~last[found + 1]]
            found = found[code[found + 2] == ord(letters[1])]
        begins[found + 1] = False
        after = found + len(letters) + 1
        begins[after[after < len(code)]] = True
    return begins


def _piece_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the pieces of texts, and the rows with letters that are foreign to the cut."""
    starts, foreign = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        at, code = _code_points(data[offsets[row] : offsets[stop]])
        if len(at):
            first = np.zeros(len(at), bool)
            begin = offsets[row:stop][np.diff(offsets[row : stop + 1]) > 0] - offsets[row]
            first[np.searchsorted(at, begin)] = True
            kind = _kinds()[code]
            starts.append((at[_cuts(code, kind, first)] + offsets[row]).astype(np.int32))
            strange = at[kind == _FOREIGN] + offsets[row]
            foreign.append(np.unique(np.searchsorted(offsets, strange, "right") - 1))
        row = stop
    return np.concatenate(starts), np.concatenate(foreign)


@cache
def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level BPE writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + place) for place, b in enumerate(other)}


@cache
def _packers(count: int) -> Callable:
    """Writes so many ids as little-endian unsigned 32-bit integers."""
    return struct.Struct(f"<{count}I").pack


class Encoder:
    """Encodes whole texts with a tokenizer file: one by one, where the ids of pieces met before are kept, up to a fixed
    number of pieces, or a batch of them, where a piece is encoded once for all texts and nothing is kept.

    Texts with letters outside the Latin blocks and texts that hold the name of an added token go through the tokenizer
    as they are. ``special`` says what names of special tokens inside a text are: those tokens, as in the tokenizer's
    file, or ordinary text.
    """

    def __init__(self, path: str, special: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.spelling = np.array([ord(self.letters[byte]) for byte in range(256)], "<u4")

    def piece(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        found = self.model.tokenize(spelled)
        return _packers(len(found))(*[token.id for token in found])

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        is_latin, cut = _latin()
        if not is_latin(text) or any(name in text for name in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces, known = cut(text), self.known
        coded = list(map(known.get, pieces))
        if None in coded:
            if len(known) > CACHED_PIECES:
                known.clear()
            for at, found in enumerate(coded):
                if found is None:
                    piece = pieces[at]
                    coded[at] = known[piece] = known.get(piece) or self.piece(piece)  # it may be there by now
        return b"".join(coded)

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts, one text after the other, and how many each has. Each different piece is encoded once."""
        whole = np.zeros(len(texts), bool)
        for name in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, name), False).to_numpy(zero_copy_only=False)
        data, offsets = text_bytes(texts)
        starts, foreign = _piece_starts(data, offsets)
        whole[foreign] = True
        if whole.any():
            return self._encoded_apart(texts, whole)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        ends = np.append(starts, np.int32(len(data)))
        cut = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        found, sizes = self._pieces(cut.dictionary)
        piece, before = cut.indices.to_numpy(), np.cumsum(sizes) - sizes
        blocks = [piece[at : at + BLOCK_PIECES] for at in range(0, len(piece), BLOCK_PIECES)]
        ids = np.concatenate([found[ragged_ranges(before[block], sizes[block])] for block in blocks])
        sums = np.append(0, np.cumsum(sizes[piece]))
        return ids, np.diff(sums[np.searchsorted(starts, offsets)])

    def _encoded_apart(self, texts: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encoded`, the texts that ``whole`` marks by the tokenizer as they are."""
        ids, sizes = self.encoded(texts.filter(pa.array(~whole)))
        cut = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        apart = iter(texts.filter(pa.array(whole)).to_pylist())
        rows = [np.frombuffer(self.ids(next(apart)), "<u4") if one else next(cut) for one in whole.tolist()]
        return np.concatenate(rows), np.array([len(x) for x in rows])

    def _pieces(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different pieces, one after the other, and how many each has."""
        data, offsets = text_bytes(pieces)
        ids, sizes = [np.zeros(0, np.uint32)], np.zeros(len(pieces), np.int64)
        for at in range(0, len(pieces), SPELLED_PIECES):
            here = offsets[at : at + SPELLED_PIECES + 1]
            letters = self.spelling[data[here[0] : here[-1]]].tobytes().decode("utf-32-le")
            ends = (here - here[0]).tolist()
            found = [self.model.tokenize(letters[begin:end]) for begin, end in pairwise(ends)]
            sizes[at : at + len(found)] = list(map(len, found))
            ids.append(np.array([token.id for tokens in found for token in tokens], np.uint32))
        return np.concatenate(ids), sizes


@cache
def encoder(path: str, special: bool) -> Encoder:
    """One encoder of a kind for each Python worker."""
    return Encoder(path, special)


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


def _encode_partition(path: str, end_id: int | None, special: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @giving_back
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, row = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for texts in chunks(batch, "text", ENCODED_BYTES):
                found, sizes = encoder(path, special).encoded(texts.column("text"))
                if end_id is not None:
                    found, sizes = np.insert(found, np.cumsum(sizes), np.uint32(end_id)), sizes + 1
                offsets = np.append(0, np.cumsum(sizes))
                at = 0
                for piece in chunks(texts, "text"):
                    here = offsets[at : at + piece.num_rows + 1]
                    ids = pa.ListArray.from_arrays(
                        pa.array((here - here[0]).astype(np.int32)), pa.array(found[here[0] : here[-1]].astype(np.int32))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("doc_id"),
                            pa.array(np.full(piece.num_rows, part, np.int32)),
                            pa.array(np.arange(row, row + piece.num_rows)),
                            pa.array(start + here[:-1]),
                            pa.array(np.diff(here)),
                            ids,
                        ],
                        ["doc_id", "part", "row", "start_in_part", "n_tokens", "ids"],
                    )
                    at, row = at + piece.num_rows, row + piece.num_rows
                start += int(offsets[-1])
        # the worker goes on to other work, which needs the memory
        encoder(path, special).known.clear()

    return encode


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int | None = END_ID,
    id_column: str = "doc_id",
    text: str = "text",
    special: bool = False,
) -> None:
    """Encode every text and write ``doc_id, part, row, start_in_part, n_tokens, ids`` in ascending id order.

    Rows are dealt to ranges of the id before they are encoded, so a text is encoded once and a file holds one range.
    NULL texts count as empty and get the end id alone; rows without id come first; rows that repeat an id stand side by
    side, ordered by a hash of their text. With ``special`` names of special tokens inside a text become those tokens, as
    by the tokenizer's file; without, they are ordinary text. The ids are dictionary-encoded inside row groups of ``ROW_GROUP_BYTES``,
    with delta encoding where a dictionary grows too large, and pages of ``PAGE_BYTES`` with a page index: a reader of
    single documents or of the counts alone skips all other pages.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = plain.repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    tokens = ordered.mapInArrow(_encode_partition(tokenizer or tokenizer_path(), end_id, special), _STORED)
    (
        tokens.write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder with ``start``, the number of ids of all documents before.

    The offset of a file comes from the counts of the files before it: one small row per file, read without any ids.
    """
    files = spark.read.schema(_STORED).parquet(folder)
    totals = sorted(files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    bases = spark.createDataFrame(rows, "part int, base long")
    return files.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("start_in_part"))


@giving_back
def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        ids = np.ascontiguousarray(lists.values.to_numpy().astype("<u4"))
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        columns = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


@query()
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), folder, special=True)
    read = read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids")
    return read.mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
