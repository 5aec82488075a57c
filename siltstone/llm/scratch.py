"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a folder of this machine; a cluster
    session is refused, as its executors could not see one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/siltstone-llm-{uuid.uuid4().hex}"


class Scratch:
    """Written tables of one run: each is computed once and survives lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        schema = frame.schema
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)


BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this subpackage to the Python workers, once per Spark application.

    It also bounds the batches that go to them in the session, by rows and bytes: texts
    can be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(), "siltstone_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.glob("*.py")):
            out.write(source, f"siltstone/llm/{source.name}")
        out.writestr("siltstone/__init__.py", (root.parent / "__init__.py").read_text())
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
