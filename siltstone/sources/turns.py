"""Work in turns: what one job puts on the executors' disks is gone before the next begins.

A shuffle lies on disk until the driver collects its garbage, which may be never while a day
is loaded. So jobs that store rows give their shuffle files back when they end, and a job
whose rows take much room on disk goes through them in several turns, by shares of a key.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows of about so many bytes of files go through a shuffle in one turn.
TURN_BYTES = 4 << 30

_holders: Counter[str] = Counter()
_guard = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within, a job's shuffle files are removed when it ends; a session that says otherwise keeps its way.

    The setting is the session's, so threads share it: the last one to leave takes it back. A frame
    that is run a second time shuffles again.
    """
    session = spark._jsparkSession.sessionUUID()
    with _guard:
        ours = _holders[session] > 0 or spark.conf.get(_CLEANUP, None) is None
        if ours:
            _holders[session] += 1
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if ours:
            with _guard:
                _holders[session] -= 1
                if not _holders[session]:
                    del _holders[session]
                    spark.conf.unset(_CLEANUP)


def turns(stored: int) -> int:
    """How many turns rows take whose files hold ``stored`` bytes."""
    return max(1, -(-stored // TURN_BYTES))


def share(rows: DataFrame, keys: Sequence[str], number: int, of: int) -> DataFrame:
    """The rows of one of ``of`` shares, dealt by the hash of ``keys``: equal keys of equal types meet."""
    if of == 1:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(of)) == number)
