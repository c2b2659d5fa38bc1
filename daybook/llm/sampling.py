"""Bounded samples of labelled rows to fit models on, and the split into folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(id_column: str = "doc_id") -> F.Column:
    """The fold that models never learn from: crc32 of the id as text leaves 2 when divided by 4. False without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def bounded_per_class(
    rows: DataFrame, label: str, id_column: str, per_class: int, most_classes: int
) -> tuple[DataFrame, dict[object, int]]:
    """About ``per_class`` rows of each class, chosen by a hash of the id, and the number of rows of each class.

    The most frequent ``most_classes`` classes are kept. The hash picks twice ``per_class`` rows at most on average, and
    a limit bounds the whole.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(most_classes).collect()
    sizes = {row[0]: row["count"] for row in counts}
    if not sizes:
        return rows.limit(0), sizes
    place = F.pmod(F.xxhash64(F.col(id_column), F.lit(11)), F.lit(1 << 40))
    chosen = F.lit(False)
    for value, count in sizes.items():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (place < int(min(1.0, per_class / count) * (1 << 40))))
    return rows.where(chosen).orderBy(place, id_column).limit(2 * per_class * len(sizes)), sizes
