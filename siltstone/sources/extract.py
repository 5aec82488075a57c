"""Source extracts: from a feed's own column names to the canonical ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.project import rename, select_declared
from siltstone.specs import DomainSpec


def extract(df: DataFrame, spec: DomainSpec, feed: str, missing: str = "skip") -> DataFrame:
    """Rename a feed's columns, tag the source, keep the domain's declared columns.

    The tag is written when the domain has a source column. ``missing`` as in
    ``select_declared``; Catalyst reduces all of it to one pruned scan.
    """
    out = rename(df, spec.feed(feed).columns)
    if spec.source_column:
        out = out.withColumn(spec.source_column, F.lit(feed))
    return select_declared(out, spec.column_names, missing, spec.types)
