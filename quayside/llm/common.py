"""What the operators of this folder share: reading columns, durable cuts of lineage, texts of Arrow batches."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see. A session that names none gets a temporary one if it is on one machine, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and (set_before := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        path = set_before.get()
    if not path and spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("a cluster needs a folder that all executors see: set spark.checkpoint.dir")
    return path or "file://" + tempfile.mkdtemp(prefix="quayside-")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and no frame reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def durable(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read from there, so lost executors cost no recomputation."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that further columns can't clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, row by row; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""
