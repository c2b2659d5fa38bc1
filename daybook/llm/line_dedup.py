"""Near-duplicate lines by deletion neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import BLANK, stored, table
from daybook.llm.registry import query
from daybook.session import broadcast_if_small

MIN_CHARS = 1
NEAR_CHARS = 24
HOT_SHARE = 1000
_AT = ["doc_id", "doc_hash", "line"]


def _normalised(line: str) -> Column:
    return F.trim(F.regexp_replace(F.col(line), f"[{BLANK}]+", " "))


def _lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Lines that can be duplicates: ``doc_id, doc_hash, line, norm, h1, h2, chars``."""
    split = docs.select("doc_id", "doc_hash", F.posexplode(F.split(F.col(text), "\n")).alias("line", "raw"))
    norm = split.select(*_AT, _normalised("raw").alias("norm")).withColumn("chars", F.char_length("norm"))
    return norm.where(F.col("chars") >= min_chars).withColumns(
        {"h1": F.xxhash64("norm"), "h2": F.xxhash64(F.lit(1), "norm")}
    )


def _half_keys(near_chars: int) -> Column:
    """Keys that two different lines within one edit share at least one of; none for lines below ``near_chars``.

    For a line of ``a`` characters and one of ``a`` or ``a + 1``, the edit leaves the first ``a / 2`` characters or the
    last ``a - a / 2`` alike. Each line has both keys in both roles, so four; the key names its half and ``a``.
    """
    keys = []
    for shorter in (0, 1):
        a = F.col("chars") - shorter
        half = F.floor(a / 2).cast("int")
        keys.append(F.xxhash64(F.lit(0), a, F.substring(F.col("norm"), F.lit(1), half)))
        keys.append(F.xxhash64(F.lit(1), a, F.substring(F.col("norm"), F.col("chars") - (a - half) + 1, a - half)))
    return F.when(F.col("chars") >= near_chars, F.array(*keys)).otherwise(F.array().cast("array<bigint>"))


def _near_lines(lines: DataFrame, marks: DataFrame) -> DataFrame:
    """Distinct lines with the earliest other distinct line within one edit, if that is earlier: ``h1, h2, near``.

    Only lines that share a half with a different line are candidates. A candidate emits the line and all its variants
    with one character deleted, the side of the edit being known from the shared half. Lines that differ by one
    substitution have an equal variant with the same place deleted; of lines that differ by one insertion the shorter is
    a variant of the longer. So the earliest line of each (variant, place), of each variant and of each whole line
    answers for all pairs without listing them; lines with one variant are as many as there are ways to insert a
    character into it, however often each occurs. The edit distance of the pair found is verified.
    """
    keyed = marks.select("h1", F.posexplode("keys").alias("role", "key"))
    shared = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("key")
    sides = keyed.join(shared, "key").groupBy("h1").agg(
        F.max((F.col("role") % 2 == 0).cast("int")).alias("second"), F.max((F.col("role") % 2 == 1).cast("int")).alias("first")
    )
    (chosen,) = broadcast_if_small(stored(sides, "line-sides"))
    whole = lines.join(chosen, "h1").groupBy("h1", "h2", "norm", "chars", "first", "second")
    candidates = stored(whole.agg(F.min(F.struct(*_AT)).alias("at")), "line-candidates")
    middle = F.floor(F.col("chars") / 2).cast("int")
    low = F.when(F.col("first") == 1, F.lit(1)).otherwise(F.floor((F.col("chars") - 1) / 2).cast("int") + 1)
    high = F.when(F.col("second") == 1, F.col("chars")).otherwise(middle + 1)
    places = F.concat(F.array(F.lit(0)), F.sequence(low, high))
    spread = candidates.select("h1", "h2", "norm", "at", F.explode(places).alias("place"))
    variant = F.concat(
        F.substring(F.col("norm"), F.lit(1), F.col("place") - 1), F.substring(F.col("norm"), F.col("place") + 1, F.length("norm"))
    )
    variants = spread.select(
        "h1", "h2", "at", "place", F.when(F.col("place") == 0, F.xxhash64("norm")).otherwise(F.xxhash64(variant)).alias("v")
    )
    same, same_place = Window.partitionBy("v"), Window.partitionBy("v", "place")
    is_whole = F.col("place") == 0
    as_whole = F.min(F.when(is_whole, F.col("at"))).over(same)
    as_variant = F.min(F.when(~is_whole, F.col("at"))).over(same)
    found = variants.select(
        "h1", "h2", "at", F.when(is_whole, as_variant).otherwise(F.least(as_whole, F.min("at").over(same_place))).alias("other")
    )
    nearest = found.where("other < at").groupBy("h1", "h2").agg(F.min("other").alias("near"))
    mine = candidates.select("h1", "h2", "norm")
    theirs = candidates.select(F.col("at").alias("near"), F.col("norm").alias("near_norm"))
    both = nearest.join(mine, ["h1", "h2"]).join(theirs, "near")
    return both.where(F.levenshtein("norm", "near_norm", 1) >= 0).select("h1", "h2", "near")


def _keepers(marks: DataFrame, keep: DataFrame) -> DataFrame:
    """The lines with the place that answers for them: ``doc_id, doc_hash, line, keep``.

    At most ``HOT_SHARE`` lines can make up more than one in ``HOT_SHARE`` of all lines each. These are broadcast; the
    others are joined by a shuffle in which no key has more than that share.
    """
    places = marks.select(*_AT, "h1", "h2")
    frequent = F.col("n") > marks.count() / HOT_SHARE
    hot, rest = (keep.where(rows).select("h1", "h2", "keep") for rows in (frequent, ~frequent))
    others = places.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti")
    return places.join(F.broadcast(hot), ["h1", "h2"]).unionByName(others.join(rest, ["h1", "h2"]))


def near_line_drops(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS
) -> DataFrame:
    """Lines that repeat an earlier line but for one edit at most: ``doc_id, doc_hash, line, keep_doc_id, keep_line``.

    Lines are compared without blanks at their ends and with each run of blanks as one. The edit bound depends on the
    length: lines of at least ``near_chars`` characters repeat each other when one edit or none is between them, shorter
    ones when they are equal; empty lines, and lines of fewer than ``min_chars`` characters, are never dropped. The order
    is that of id, hash of the text (``doc_hash``) and place in the text, rows without id first. The earliest equal or
    near line is named, whether it is itself dropped or not. Rows with one id and one text count as one place, so they do
    not drop each other's lines.
    """
    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_hash"), F.col(text).alias("text")
    )
    lines = _lines(plain, "text", max(1, min_chars))
    marks = stored(lines.select(*_AT, "h1", "h2", _half_keys(near_chars).alias("keys")), "line-marks")
    near = _near_lines(lines, marks)
    first = marks.groupBy("h1", "h2").agg(F.min(F.struct(*_AT)).alias("first"), F.count("*").alias("n"))
    keep = first.join(near, ["h1", "h2"], "left").where("n > 1 OR near IS NOT NULL")
    keep = stored(keep.select("h1", "h2", "n", F.least("first", "near").alias("keep")), "line-keep")
    found = _keepers(marks, keep).where(F.col("keep") < F.struct(*_AT))
    return found.select(*_AT, F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.line").alias("keep_line"))


def drop_near_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS
) -> DataFrame:
    """The documents without the lines of :func:`near_line_drops`, with ``n_lines`` and ``n_dropped``.

    NULL texts stay NULL with 0 lines. Columns of the documents with the names of the results are replaced.
    """
    drops = near_line_drops(docs, id_column, text, min_chars, near_chars)
    drops = drops.groupBy(F.col("doc_id").alias("drop_id"), F.col("doc_hash").alias("drop_hash"))
    drops = drops.agg(F.collect_set("line").alias("drop_lines"))
    same = F.col(id_column).cast("long").eqNullSafe(F.col("drop_id")) & (F.xxhash64(text) == F.col("drop_hash"))
    joined = docs.drop("n_lines", "n_dropped").join(drops, same, "left")
    dropped = F.coalesce(F.col("drop_lines"), F.array().cast("array<int>"))
    split = F.split(F.col(text), "\n")
    kept = F.filter(split, lambda _, place: ~F.array_contains(dropped, place))
    return joined.select(
        *[F.array_join(kept, "\n").alias(text) if name == text else F.col(name) for name in docs.columns if name not in ("n_lines", "n_dropped")],
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.size(dropped).cast("long").alias("n_dropped"),
    )


@query(f"""
WITH lines AS (
  SELECT doc_id, line, trim(regexp_replace(raw, '[{BLANK}]+', ' ', 'g'), ' ') AS t, raw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS line
        FROM documents)),
distinct_lines AS (SELECT t, len(t) AS n, min(doc_id * 1000000 + line) AS pos FROM lines WHERE len(t) >= {MIN_CHARS} GROUP BY t),
keys AS (
  SELECT t, pos, n - s AS a, 'first' AS side, substr(t, 1, (n - s) // 2) AS half FROM distinct_lines, (VALUES (0), (1)) v(s) WHERE n >= {NEAR_CHARS}
  UNION ALL
  SELECT t, pos, n - s AS a, 'last' AS side, right(t, (n - s) - (n - s) // 2) AS half FROM distinct_lines, (VALUES (0), (1)) v(s) WHERE n >= {NEAR_CHARS}),
near AS (
  SELECT x.t, min(y.pos) AS pos FROM keys x JOIN keys y USING (a, side, half)
  WHERE y.pos < x.pos AND levenshtein(x.t, y.t) <= 1 GROUP BY x.t),
keep AS (SELECT d.t, least(d.pos, coalesce(near.pos, d.pos)) AS pos FROM distinct_lines d LEFT JOIN near USING (t)),
marked AS (
  SELECT l.doc_id, l.line, l.raw, coalesce(keep.pos < l.doc_id * 1000000 + l.line, false) AS gone FROM lines l LEFT JOIN keep USING (t))
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
FROM marked GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_near_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
