"""Language identification of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import LOWER_ASCII, Words, chunks, giving_back, span_hash, span_sums, table, text_bytes, words
from daybook.llm.registry import query
from daybook.llm.sampling import held_out

FIT_PIECES = 300
FIT_ALL_PIECES = 60_000
PIECE_CHARS = 20_000
FIT_STEPS = 12
LEXICON = 8192
GRAMS = 1 << 16
AFFIXES = 1 << 14
BLOCK = 512
GROUP = 256
SLICE = 1 << 20
STAY = 0.97
UNKNOWN = "und"

LETTER_BYTES = np.zeros(256, bool)
LETTER_BYTES[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    """Weights of a feature for each language, the lexicon as sorted word hashes, and the transition weights."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


@dataclass
class Features:
    """Features of words: grams (one per byte, ``owner`` says of which word) and three of each word itself.

    ``ascii`` marks words with a letter a-z.
    """

    text: Words
    gram: np.ndarray
    gram_start: np.ndarray
    owner: np.ndarray
    single: np.ndarray
    ascii: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented Latin-1 letters."""
    low = LOWER_ASCII[data]
    accented = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
    low[accented] += 0x20
    return low


def features(column: pa.Array, lexicon: np.ndarray) -> Features:
    data, offsets = text_bytes(column)
    low = lowered(data)
    text = words(low, offsets, LETTER_BYTES)
    size = text.end - text.start
    padded = np.full(len(low) + 2, 0x20, np.uint32)
    padded[1:-1] = np.where(LETTER_BYTES[low], low, 0x20)
    gram = (padded[:-2] * np.uint32(0x9E3779B1)) ^ (padded[1:-1] * np.uint32(0x85EBCA6B)) ^ (padded[2:] * np.uint32(0xC2B2AE35))
    gram = (gram >> np.uint32(15)) % np.uint32(GRAMS)
    inside = LETTER_BYTES[low]
    gram_start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else np.zeros(0, np.int64)
    sums = span_sums(low)
    prefix = span_hash(sums, text.start, np.minimum(text.start + 3, text.end)) % np.uint64(AFFIXES)
    suffix = span_hash(sums, np.maximum(text.end - 4, text.start), text.end) % np.uint64(AFFIXES)
    base = GRAMS + 2 * AFFIXES
    entry = np.full(len(text.hash), base + LEXICON, np.int64)
    if len(lexicon) and len(text.hash):
        at = np.minimum(np.searchsorted(lexicon, text.hash), len(lexicon) - 1)
        entry = np.where(lexicon[at] == text.hash, base + at, entry)
    single = np.stack([GRAMS + prefix.astype(np.int64), GRAMS + AFFIXES + suffix.astype(np.int64), entry])
    owner = np.repeat(np.arange(len(size)), size)
    plain = np.maximum.reduceat(low[inside] < 0x80, gram_start) if len(size) else np.zeros(0, bool)
    return Features(text, gram[inside].astype(np.int64), gram_start, owner, single, plain)


def emissions(found: Features, weights: np.ndarray) -> np.ndarray:
    """Score of each word for each language, some words at a time."""
    words_here = len(found.text.hash)
    score = np.zeros((words_here, weights.shape[1]), np.float32)
    ends = np.append(found.gram_start[1:], len(found.gram))
    low = 0
    while low < words_here:
        first = found.gram_start[low]
        high = max(low + 1, int(np.searchsorted(ends, first + SLICE, "right")))
        grams = weights[found.gram[first : ends[high - 1]]]
        score[low:high] = np.add.reduceat(grams, found.gram_start[low:high] - first, axis=0)
        for row in found.single:
            score[low:high] += weights[row[low:high]]
        low = high
    return score


def word_places(text: Words) -> np.ndarray:
    """Place of each word in its text."""
    return np.arange(len(text.row)) - text.first[text.row]


def _locals(score: np.ndarray) -> np.ndarray:
    return np.exp(score.astype(np.float64) - score.max(axis=1, keepdims=True))


def _steps(opens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of blocks, longest first, and the words of each step: the t-th words of the blocks that have one."""
    order = np.argsort(-sizes, kind="stable")
    having = np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")
    return order, [opens[order[:n]] + t for t, n in enumerate(having.tolist())]


def _block_moves(local: np.ndarray, step: np.ndarray, opens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each block the weight of all paths from each label of its first word to each label of its last, up to a factor."""
    order, lines = _steps(opens, sizes)
    moves = local[lines[0]][:, :, None] * np.eye(local.shape[1])
    for line in lines[1:]:
        now = (moves[: len(line)] @ step) * local[line][:, None, :]
        moves[: len(line)] = now / now.max(axis=(1, 2), keepdims=True)
    result = np.empty_like(moves)
    result[order] = moves
    return result


def _messages(
    score: np.ndarray, opens: np.ndarray, sizes: np.ndarray, first: np.ndarray, step: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What the words before a block say of its first word, and what the words after it say of its last.

    Only texts of several blocks need their path weights; groups of blocks bound the memory.
    """
    last = np.append(first[1:], True)
    arrive, leave = np.tile(start, (len(opens), 1)), np.ones((len(opens), len(start)))
    several = np.flatnonzero(~(first & last))
    groups = [several[low : low + GROUP] for low in range(0, len(several), GROUP)]

    def moves_of(group: np.ndarray) -> np.ndarray:
        span = slice(opens[group[0]], opens[group[-1]] + sizes[group[-1]])
        return _block_moves(_locals(score[span]), step, opens[group] - span.start, sizes[group])

    moves = None
    for group in groups:
        moves = moves_of(group)
        for block, move in zip(group.tolist(), moves, strict=True):
            if not last[block]:
                line = arrive[block] @ move @ step
                arrive[block + 1] = line / line.sum()
    for number, group in enumerate(reversed(groups)):
        moves = moves_of(group) if number else moves
        for block, move in zip(group[::-1].tolist(), moves[::-1], strict=True):
            if not first[block]:
                line = step @ (move @ leave[block])
                leave[block - 1] = line / line.sum()
    return arrive, leave


def forward_backward(
    score: np.ndarray, text: Words, model: Model, with_moves: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word for each language and, if asked for, the expected number of transitions.

    Each text is one chain. It is worked on in blocks of ``BLOCK`` words, many blocks at once; messages are carried over
    the edges of blocks, so that results do not depend on where these lie.
    """
    kinds = score.shape[1]
    posterior, counted = np.zeros((len(score), kinds)), np.zeros((kinds, kinds))
    if not len(score):
        return posterior, counted
    place = word_places(text)
    opens = np.flatnonzero(place % BLOCK == 0)
    sizes = np.diff(np.append(opens, len(place)))
    step = np.exp(model.transitions - model.transitions.max())
    start = np.exp(model.start - model.start.max())
    arrive, leave = _messages(score, opens, sizes, place[opens] == 0, step, start)
    tail = start[None]
    for low in range(0, len(opens), GROUP):
        group = slice(low, low + GROUP)
        begin, end = opens[low], opens[group][-1] + sizes[group][-1]
        local = _locals(score[begin:end])
        order, lines = _steps(opens[group] - begin, sizes[group])
        forward, backward = np.empty_like(local), np.empty_like(local)
        line = arrive[group][order]
        for t, at in enumerate(lines):
            line = line[: len(at)] @ step if t else line
            line = line * local[at]
            line /= line.sum(axis=1, keepdims=True)
            forward[at] = line
        ends = leave[group][order]
        line = ends[:0]
        for at in reversed(lines):
            line = np.concatenate((line, ends[len(line) : len(at)]))
            backward[at] = line
            line = (line * local[at]) @ step.T
            line /= line.sum(axis=1, keepdims=True)
        both = forward * backward
        posterior[begin:end] = both / both.sum(axis=1, keepdims=True)
        if with_moves:
            after = local * backward
            follows = np.flatnonzero(place[begin:end] > 0)
            previous = np.concatenate((tail, forward[:-1]))
            weight = ((previous[follows] @ step) * after[follows]).sum(axis=1, keepdims=True)
            counted += step * (previous[follows].T @ (after[follows] / weight))
        tail = forward[-1:]
    return posterior, counted


def fit(texts: list[str], labels: list[str]) -> Model:
    """Fit on whole texts with one language each.

    Counts of features give first weights; with them and a bonus for the language of the text every word gets a label,
    so that words of another language inside a text are not learned as its own. Weights of features and of transitions
    then climb the likelihood of these labels, with expectations from forward-backward.
    """
    languages = sorted(set(labels))
    kinds = len(languages)
    size = GRAMS + 2 * AFFIXES + LEXICON + 1
    if not kinds:
        return Model([], np.zeros((size, 0), np.float32), np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    column = pa.array(texts, pa.string())
    seen, counts = np.unique(features(column, np.zeros(0, np.uint64)).text.hash, return_counts=True)
    common = seen[np.argsort(-counts, kind="stable")[:LEXICON]]
    found = features(column, np.sort(common))
    text = found.text
    own = np.array([languages.index(x) for x in labels])[text.row]

    def totals(per_word: np.ndarray) -> np.ndarray:
        out = np.empty((size, kinds))
        for kind in range(kinds):
            line = np.bincount(found.gram, per_word[found.owner, kind], minlength=size)
            for row in found.single:
                line += np.bincount(row, per_word[:, kind], minlength=size)
            out[:, kind] = line
        return out

    one = np.eye(kinds)
    counted = totals(one[own]) + 0.5
    weights = np.log(counted / counted.sum(axis=0))
    weights -= weights.mean(axis=1, keepdims=True)
    weights[-1] = 0
    stay = np.log(np.where(np.eye(kinds, dtype=bool), STAY, (1 - STAY) / max(1, kinds - 1)))
    model = Model(languages, weights.astype(np.float32), np.sort(common), stay, np.zeros(kinds))
    posterior, _ = forward_backward(emissions(found, model.weights) + one[own], text, model)
    label = posterior.argmax(axis=1)
    goal = totals(one[label])
    follows = np.flatnonzero(word_places(text)[1:] > 0)
    moved = np.zeros((kinds, kinds))
    np.add.at(moved, (label[follows], label[follows + 1]), 1)
    squared, squared_moves = np.full((size, kinds), 1e-3), np.full((kinds, kinds), 1e-3)
    for _ in range(FIT_STEPS):
        posterior, moves = forward_backward(emissions(found, model.weights), text, model, with_moves=True)
        up = goal - totals(posterior) - 0.05 * model.weights
        up_moves = moved - moves - 0.05 * model.transitions
        squared += up**2
        squared_moves += up_moves**2
        model.weights = (model.weights + 0.2 * up / np.sqrt(squared)).astype(np.float32)
        model.transitions = model.transitions + 0.2 * up_moves / np.sqrt(squared_moves)
    return model


def train(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = FIT_PIECES,
    all_pieces: int = FIT_ALL_PIECES,
) -> Model:
    """A model from a bounded sample of rows with a language, outside the held-out fold.

    Texts are cut into pieces of ``PIECE_CHARS`` characters (most are one piece), so that long texts are learned from as
    any others. A hash picks about ``per_language`` pieces of each language, or fewer where all languages together would
    have more than ``all_pieces``; every language is learned. The driver holds twice that at most, and the weights of a
    language take 0.4 MB.
    """
    usable = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    usable = usable.where(~held_out()).where("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    counts = usable.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / PIECE_CHARS)).alias("pieces")).collect()
    if not counts:
        return fit([], [])
    each = max(1, min(per_language, all_pieces // len(counts)))
    shares = [(row.lang, int(min(1.0, each / row.pieces) * (1 << 40))) for row in counts]
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))
    whole = F.length("text") <= PIECE_CHARS
    pieces = usable.select(
        "doc_id", "lang", F.posexplode(F.when(whole, F.array("text")).otherwise(cut)).alias("piece", "text")
    )
    place = F.pmod(F.xxhash64("doc_id", "piece", F.lit(11)), F.lit(1 << 40))
    share = docs.sparkSession.createDataFrame(shares, "lang string, share long")
    chosen = pieces.join(F.broadcast(share), "lang").where(place < F.col("share"))
    rows = chosen.orderBy(place, "doc_id", "piece", "lang", "text").limit(2 * each * len(counts)).select("text", "lang").collect()
    return fit([row.text for row in rows], [row.lang for row in rows])


def _label(shared: object, text: str, with_runs: bool) -> Callable:
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    @giving_back
    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        kinds = len(model.languages)
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in chunks(batch, text):
                found = features(part.column(text), model.lexicon)
                n = part.num_rows
                mean, best = np.zeros(n), np.full(n, kinds)
                if kinds and len(found.text.hash):
                    posterior, _ = forward_backward(emissions(found, model.weights), found.text, model)
                    sums = np.stack([np.bincount(found.text.row, posterior[:, k], minlength=n) for k in range(kinds)], axis=1)
                    counts = found.text.counts
                    best = np.where(counts > 0, sums.argmax(axis=1), kinds)
                    mean = np.where(counts > 0, sums.max(axis=1) / np.maximum(counts, 1), 0.0)
                    ascii_word = np.bincount(found.text.row, found.ascii, minlength=n) > 0
                    for row in np.flatnonzero((counts > 0) & ~ascii_word).tolist():
                        if not any(c.isalpha() for c in part.column(text)[row].as_py()):
                            best[row], mean[row] = kinds, 0.0
                kept = [name for name in part.schema.names if name != text]
                columns = [part.column(name) for name in kept]
                columns += [pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(mean, 0.0, 1.0))]
                kept = [*kept, "lang_pred", "lang_score"]
                if with_runs:
                    columns.append(_runs(found, posterior.argmax(axis=1) if kinds and len(found.text.hash) else None, n, names, run_type))
                    kept.append("lang_runs")
                yield pa.RecordBatch.from_arrays(columns, kept)

    return label


def _runs(found: Features, label: np.ndarray | None, rows: int, names: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Neighbouring words of one language, as (language, number of words), for each row."""
    out: list[list[dict]] = [[] for _ in range(rows)]
    if label is not None:
        row = found.text.row
        cut = np.flatnonzero((label[1:] != label[:-1]) | (row[1:] != row[:-1])) + 1
        bounds = np.concatenate(([0], cut, [len(label)]))
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[row[begin]].append({"lang": names[label[begin]], "words": end - begin})
    return pa.array(out, kind)


def label_languages(
    docs: DataFrame, model: Model, text: str = "text", with_runs: bool = False, keep_text: bool = True
) -> DataFrame:
    """The documents with ``lang_pred``, ``lang_score`` and, if asked for, ``lang_runs``, with or without the text column.

    Every word of the whole text gets a posterior for each language; the language with the largest sum is predicted and
    its mean posterior is the score. NULL texts and texts without a letter are ``und`` with score 0, and so is every
    text when the model knows no language. ``lang_runs`` lists the runs of words of one language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("lang_pred", "lang_score", "lang_runs")
    kept = [field for field in plain.schema.fields if keep_text or field.name != text]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    schema += ", lang_pred string, lang_score double" + ", lang_runs array<struct<lang: string, words: bigint>>" * with_runs
    renamed = plain.withColumn("label_text", F.col(text))
    return (renamed if keep_text else renamed.drop(text)).mapInArrow(_label(shared, "label_text", with_runs), schema)


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    return label_languages(narrow, train(docs), keep_text=False).withColumnRenamed("lang_score", "score")
