"""A bounded sample of labelled rows to fit a classifier on; bounds are parameters of the callers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id has the fold of an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def sampled_ids(labels: DataFrame, label: str, folds: int, held_out: int, per_class: int) -> DataFrame:
    """doc_id and label of at most ``per_class`` rows per class, in hash order, outside the held-out fold.

    Rows without id or label are left out; of labels that disagree on an id the highest counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.where(fold("doc_id", folds) != held_out)
    one = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    # A top-k per class keeps at most ``per_class`` rows of every task; a window would sort a whole class in one.
    classes = [one.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for x in (0, 1)]
    return classes[0].unionAll(classes[1])


def sampled_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text and label of the sampled rows; the sample is bounded, so it is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
