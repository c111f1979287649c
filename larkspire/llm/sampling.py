"""Bounded, repeatable samples of labelled rows, stratified by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps in which a row's share is told apart.
STEPS = 1 << 20
#: Rows that a class keeps, about, however many classes there are; with 20 the chance of none is 2e-9.
LEAST = 20


def stratified(rows: DataFrame, label: str, key: str, per_class: int, classes: int = 200) -> tuple[DataFrame, dict]:
    """About per_class rows of each class, chosen by a hash of key, and the classes' counts.

    The counts cover all rows and all classes. A class with at most per_class rows is taken whole; of a larger one each row
    is taken with probability per_class / count. If there are more than so many classes, per_class shrinks, to LEAST at
    least, so the sample holds about classes * per_class rows, or LEAST of each class, whatever the input's size.
    Null labels and null keys take no part. The result has the columns key and label.
    """
    known = rows.select(key, label).where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counted = known.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).collect()  # one row for each class
    counts = {r[label]: r["n"] for r in counted}
    if not counts:
        return known.where(F.lit(False)), counts
    if len(counts) > classes:
        per_class = min(per_class, max(LEAST, per_class * classes // len(counts)))
    share = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(STEPS, round(STEPS * per_class / n)))])
    return known.where(F.pmod(F.xxhash64(F.col(key)), F.lit(STEPS)) < F.coalesce(share[F.col(label)], F.lit(0))), counts
