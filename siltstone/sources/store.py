"""Tables as directories, one per batch, so that no job overwrites what it reads.

Layout: ``<root>/<layer>/<table>/_state_batch=<batch>/``. A history table adds
``_is_current=true|false`` below: a batch writes its current versions and only those
versions it has closed itself; the closed versions of earlier batches stay where they
are. A history table can also be partitioned by one DATE column that its key holds or
determines, and a table without history can be *dated*: kept by a DATE column. A batch
then writes the dates it touches and no others; the rows of a date are those of the
last batch that wrote it. Reading a state thus means choosing directories, and adding a
day costs that day, however long the history is.

Which batch wrote a date last is in a small list that every batch leaves, complete, under
``_current/`` (history) or ``_dated/``: one row for each date. So reading a date lists that
date's directory, not all batches times all dates. The list is written after the rows, and
a batch without it does not count.

Running a batch again replaces its own directory and gives the same rows. After
re-running an old batch, run the later ones again in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources import paths
from siltstone.sources.turns import shuffles_released

_BATCH = "_state_batch"
_FLAG = "_is_current"
_HISTORY_LIST, _DATED_LIST = "_current", "_dated"
_CODEC = "spark.sql.parquet.compression.codec"
#: Marks, in the schema of a batch's files, a column that is NULL in all rows of the batch.
_EMPTY = "siltstone.empty"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> int:
    """Write and return the number of rows, counted while they are written."""
    return write_observed(df, path, {}, mode, fmt, partition_by)["rows"]


def write_observed(
    df: DataFrame,
    path: str,
    aggregates: Mapping[str, Column],
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    empty: Iterable[str] = (),
    more: bool = False,
) -> dict[str, int]:
    """Write, and return ``rows`` and the given aggregates, all taken while the rows are written.

    With ``more``, other rows follow, and the files are not marked as complete. The shuffle
    files of the job are removed at its end.

    The columns ``empty`` must be NULL in all rows. They are stored like the others, but join the
    rows as the last step: no shuffle and no sort below carries them, the sort by
    ``partition_by`` included. The stored schema marks them.
    """
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **aggregates}
    unfilled = set(empty)
    held = df.drop(*unfilled) if unfilled else df
    rows = held.observe(seen, *[column.alias(name) for name, column in wanted.items()])
    if unfilled:
        if partition_by and not _writes_side_by_side(df.sparkSession):
            rows = rows.sortWithinPartitions(*partition_by)
        rows = rows.select(*[_stored(field, unfilled) for field in df.schema.fields])
    writer = rows.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "parquet" and df.sparkSession.conf.get(_CODEC) == "snappy":
        # Half of a stored version is the text of its hash, which Spark's default codec leaves as it is.
        writer = writer.option("compression", "zstd")
    if more:
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    with shuffles_released(df.sparkSession):
        writer.save(path)
    return {name: seen.get[name] for name in wanted}


def _writes_side_by_side(spark: SparkSession) -> bool:
    """Whether a task keeps a file open for each of several dates, so that rows need no sort by date."""
    return int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")) > 0


def _stored(field: T.StructField, unfilled: set[str]) -> Column:
    if field.name in unfilled:
        return F.lit(None).cast(field.dataType).alias(field.name, metadata={_EMPTY: True})
    column = F.col(f"`{field.name}`")
    return column.alias(field.name, metadata={}) if _EMPTY in (field.metadata or {}) else column


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at ``path``; a damaged table exists and fails on read."""
    return paths.exists(spark, path)


def table_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[T.StructField]:
    """The columns of a table; none if there is no table."""
    return read_table(spark, path, fmt).schema.fields if table_exists(spark, path) else []


def _turns(df: DataFrame | Sequence[DataFrame]) -> Sequence[DataFrame]:
    return [df] if isinstance(df, DataFrame) else df


def _batch_of(path: str) -> str:
    """The batch in whose directory ``path`` lies."""
    return path.split(f"/{_BATCH}=", 1)[1].split("/", 1)[0]


class Store:
    """The layered tables under one root."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, layer: str, table: str, batch: str | None = None) -> str:
        base = f"{self.root}/{layer}/{table}"
        return base if batch is None else f"{base}/{_BATCH}={batch}"

    def batches(self, layer: str, table: str) -> list[str]:
        """Completed batches in order."""
        base = self.path(layer, table)
        done = {_batch_of(p) for p in paths.children(self.spark, base, f"{_BATCH}=*/_SUCCESS")}
        for name in (_HISTORY_LIST, _DATED_LIST):
            listed = paths.children(self.spark, base, f"{name}/{_BATCH}=*/_SUCCESS")
            if listed:
                done &= {_batch_of(p) for p in listed}
        return sorted(done)

    def latest(self, layer: str, table: str, before: str | None = None) -> str | None:
        """The last completed batch, strictly before ``before`` when that is given."""
        done = [b for b in self.batches(layer, table) if before is None or b < before]
        return done[-1] if done else None

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.batches(layer, table))

    def write(
        self,
        df: DataFrame | Sequence[DataFrame],
        layer: str,
        table: str,
        batch: str,
        partition_by: Sequence[str] = (),
        empty: Iterable[str] = (),
    ) -> int:
        """Store the rows of a batch. Several frames are stored in turn; the batch counts after the last."""
        path, rows = self.path(layer, table, batch), 0
        turns = _turns(df)
        for number, turn in enumerate(turns, 1):
            mode = "overwrite" if number == 1 else "append"
            wrote = write_observed(turn, path, {}, mode, self.fmt, partition_by, empty, number < len(turns))
            rows += wrote["rows"]
        return rows

    def read(self, layer: str, table: str, batch: str | None = None) -> DataFrame:
        """A table without history as of a batch, the latest by default; a dated one with all its dates."""
        chosen = batch or self._latest_or_fail(layer, table)
        if self._has_list(layer, table, _DATED_LIST):
            return self.read_dated(layer, table, chosen)
        return self._own_rows(layer, table, chosen)

    def write_history(
        self,
        df: DataFrame | Sequence[DataFrame],
        layer: str,
        table: str,
        batch: str,
        partition: str | None = None,
        empty: Iterable[str] = (),
    ) -> int:
        """Store current versions and the versions closed by ``batch``.

        With ``partition``, ``df`` must hold all current rows of every date it holds, in all its
        turns together. The columns ``empty`` must be NULL in all rows (see ``write_observed``).
        """
        self._require_date(_turns(df)[0], partition)
        rows = self.write(df, layer, table, batch, [_FLAG, partition] if partition else [_FLAG], empty)
        if partition:
            self._list_parts(layer, table, batch, _HISTORY_LIST, f"{_FLAG}=true/")
        return rows

    def write_dated(
        self,
        df: DataFrame | Sequence[DataFrame],
        layer: str,
        table: str,
        batch: str,
        partition: str,
        empty: Iterable[str] = (),
    ) -> int:
        """Store the dates that ``df`` holds, each of them whole, and leave the others as they are.

        The columns ``empty`` must be NULL in all rows (see ``write_observed``).
        """
        self._require_date(_turns(df)[0], partition)
        rows = self.write(df, layer, table, batch, [partition], empty)
        self._list_parts(layer, table, batch, _DATED_LIST, "")
        return rows

    def read_history(self, layer: str, table: str, batch: str | None = None) -> DataFrame:
        """Every version as of a batch, the latest by default."""
        chosen = batch or self._latest_or_fail(layer, table)
        closed = self._closed(layer, table, None, chosen)
        return self._load(layer, table, chosen, self._current(layer, table, chosen) + closed)

    def read_current(
        self, layer: str, table: str, batch: str | None = None, dates: Iterable | None = None
    ) -> DataFrame:
        """The current versions as of a batch, the latest by default; of the given dates or of all."""
        chosen = batch or self._latest_or_fail(layer, table)
        return self._load(layer, table, chosen, self._current(layer, table, chosen, dates))

    def empty_columns(
        self, layer: str, table: str, batch: str | None = None, dates: Iterable | None = None
    ) -> set[str]:
        """Columns of which the files of the current versions say that they are NULL in all rows.

        Every batch that wrote some of these rows must say so; a batch that says nothing
        leaves none. Reads a footer for each of these batches, no rows.
        """
        chosen = batch or self._latest_or_fail(layer, table)
        wrote = sorted({_batch_of(p) for p in self._current(layer, table, chosen, dates)})

        def marked(written: str) -> set[str]:
            fields = self._own_rows(layer, table, written).schema.fields
            return {f.name for f in fields if (f.metadata or {}).get(_EMPTY)}

        if not wrote:
            return set()
        with ThreadPoolExecutor(max_workers=8) as pool:
            return set.intersection(*pool.map(marked, wrote))

    def read_closed(
        self, layer: str, table: str, after: str | None = None, batch: str | None = None
    ) -> DataFrame:
        """The versions that batches after ``after`` and up to ``batch`` closed."""
        chosen = batch or self._latest_or_fail(layer, table)
        return self._load(layer, table, chosen, self._closed(layer, table, after, chosen))

    def read_dated(
        self, layer: str, table: str, batch: str | None = None, dates: Iterable | None = None
    ) -> DataFrame:
        """A dated table as of a batch, the latest by default; of the given dates or of all."""
        chosen = batch or self._latest_or_fail(layer, table)
        directories = self._part_paths(layer, table, chosen, _DATED_LIST, "", dates)
        return self._load(layer, table, chosen, directories, flagged=False)

    def dates(self, layer: str, table: str, batch: str | None = None) -> dict[str, str]:
        """Of a table kept by date: every date and the batch that wrote its rows as of ``batch``."""
        chosen = batch or self._latest_or_fail(layer, table)
        for name in (_HISTORY_LIST, _DATED_LIST):
            if self._has_list(layer, table, name):
                parts = self._parts(layer, table, chosen, name)
                return {part.split("=", 1)[1]: written for part, written in parts.items()}
        return {}

    def holds(self, layer: str, table: str, batch: str, dates: Iterable) -> bool:
        """Whether any of the given dates has current rows as of a batch."""
        return bool(self._current(layer, table, batch, dates))

    def batch_bytes(self, layer: str, table: str, batch: str) -> int:
        """What the files hold that a batch wrote; 0 without such a batch."""
        return paths.stored_bytes(self.spark, [self.path(layer, table, batch)])

    def current_bytes(self, layer: str, table: str, batch: str, dates: Iterable | None = None) -> int:
        """What the files of the current rows hold as of a batch, of the given dates or of all."""
        return paths.stored_bytes(self.spark, self._current(layer, table, batch, dates))

    def has_current(self, layer: str, table: str, batch: str) -> bool:
        """Whether any row is current as of a batch; days without deliveries leave none behind."""
        return bool(self._current(layer, table, batch))

    def _own_rows(self, layer: str, table: str, batch: str) -> DataFrame:
        """What one batch wrote."""
        return read_table(self.spark, self.path(layer, table, batch), self.fmt)

    def _require_date(self, df: DataFrame, partition: str | None) -> None:
        if partition and df.schema[partition].dataType != T.DateType():
            raise ValueError(f"a table is partitioned by a DATE column, not {partition}")

    def _has_list(self, layer: str, table: str, name: str) -> bool:
        return paths.exists(self.spark, f"{self.path(layer, table)}/{name}")

    def _list_path(self, layer: str, table: str, batch: str, name: str) -> str:
        return f"{self.path(layer, table)}/{name}/{_BATCH}={batch}"

    def _list_parts(self, layer: str, table: str, batch: str, name: str, prefix: str) -> None:
        """Write the list of a batch: that of the one before with the dates it wrote itself."""
        before = [b for b in self.batches(layer, table) if b < batch]
        parts = self._parts(layer, table, before[-1], name) if before else {}
        own = paths.children(self.spark, self.path(layer, table, batch), f"{prefix}*=*")
        parts |= {path.rsplit("/", 1)[1]: batch for path in own}
        rows = self.spark.createDataFrame(sorted(parts.items()), "part string, written_by string")
        rows.coalesce(1).write.mode("overwrite").parquet(self._list_path(layer, table, batch, name))

    def _parts(self, layer: str, table: str, batch: str, name: str) -> dict[str, str]:
        """Directory name of each date -> the batch that wrote it: as many rows as there are dates."""
        path = self._list_path(layer, table, batch, name)
        rows = self.spark.read.schema("part string, written_by string").parquet(path)
        return {row.part: row.written_by for row in rows.collect()}

    def _part_paths(
        self, layer: str, table: str, batch: str, name: str, prefix: str, dates: Iterable | None
    ) -> list[str]:
        wanted = None if dates is None else {str(d) for d in dates}
        return sorted(
            f"{self.path(layer, table, written)}/{prefix}{part}"
            for part, written in self._parts(layer, table, batch, name).items()
            if wanted is None or part.split("=", 1)[1] in wanted
        )

    def _closed(self, layer: str, table: str, after: str | None, batch: str) -> list[str]:
        known = {b for b in self.batches(layer, table) if b <= batch and (after is None or b > after)}
        closed = paths.children(self.spark, self.path(layer, table), f"{_BATCH}=*/{_FLAG}=false")
        return [path for path in closed if _batch_of(path) in known]

    def _current(self, layer: str, table: str, batch: str, dates: Iterable | None = None) -> list[str]:
        """Directories of the current rows: the batch's own, or per date the last one written."""
        if self._has_list(layer, table, _HISTORY_LIST):
            return self._part_paths(layer, table, batch, _HISTORY_LIST, f"{_FLAG}=true/", dates)
        if dates is not None:
            raise ValueError(f"{layer}/{table} is not kept by date")
        return paths.children(self.spark, self.path(layer, table, batch), f"{_FLAG}=true")

    def _load(
        self, layer: str, table: str, newest: str, directories: list[str], flagged: bool = True
    ) -> DataFrame:
        # The newest batch with rows knows every column; older files read as NULL in new ones.
        # A batch without rows has no file that could tell its columns.
        done = set(self.batches(layer, table))
        pattern = f"{_BATCH}=*/{_FLAG}=*" if flagged else f"{_BATCH}=*/*=*"
        filled = {_batch_of(p) for p in directories}
        if newest not in filled:
            own = paths.children(self.spark, self.path(layer, table, newest), pattern.split("/", 1)[1])
            filled |= {newest} if own else set()
        if not filled:
            everywhere = paths.children(self.spark, self.path(layer, table), pattern)
            filled = {_batch_of(p) for p in everywhere} & done
        known = self._own_rows(layer, table, max(filled, default=newest)).schema
        # What a batch says of its own files is not true of every row that is read.
        fields = [T.StructField(f.name, f.dataType, f.nullable) for f in known.fields if f.name != _FLAG]
        if flagged:
            fields.append(T.StructField(_FLAG, T.BooleanType()))
        if not directories:
            return self.spark.createDataFrame([], T.StructType(fields))
        schema = T.StructType([*fields, T.StructField(_BATCH, T.StringType())])
        reader = self.spark.read.format(self.fmt).schema(schema)
        reader = reader.option("basePath", self.path(layer, table))
        return reader.load(directories).drop(_BATCH)

    def _latest_or_fail(self, layer: str, table: str) -> str:
        batch = self.latest(layer, table)
        if batch is None:
            raise FileNotFoundError(f"no completed batch of {layer}/{table} under {self.root}")
        return batch
