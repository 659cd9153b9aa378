"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# functions of this package travel to Python workers by value: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. On one machine, where it is not set, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + os.path.join(tempfile.gettempdir(), f"lumenlink-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Unlike checkpoint(), which computes the last stage twice, this computes it
    once. The tables are deleted by ``drop`` or when the driver exits.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lumenlink-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not hasattr(spark, "_lumenlink_written"):  # kept with the session: this module travels to workers
        spark._lumenlink_written = []
        atexit.register(drop_materialized, spark)
    spark._lumenlink_written.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._lumenlink_path = path
    del df
    tidy(spark)
    return back


def tidy(spark: SparkSession) -> None:
    """Give back what the driver's Python and JVM no longer use; Spark's cleaner then drops shuffles and broadcasts of plans that are gone."""
    gc.collect()
    release()
    spark._jvm.System.gc()
    try:
        beans, name = spark._jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), spark._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        beans.invoke(name, "systemTrimNativeHeap", None, None)
    except Exception:  # noqa: BLE001  older JVMs have no such command
        return


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def drop(df: DataFrame) -> None:
    """Delete a table that ``materialize`` has returned, when nothing lazy reads it any more."""
    spark = df.sparkSession
    _delete(spark, df._lumenlink_path)
    spark._lumenlink_written.remove(df._lumenlink_path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete the intermediate tables that this driver wrote."""
    while spark._lumenlink_written:
        path = spark._lumenlink_written.pop()
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended: then the folder's owner cleans up
            return


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the whole text (null: empty), under the names doc_id and text."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def with_facts(docs: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``facts`` (doc_id, th, ...) to whole rows by id and text hash (nulls equal).

    The rows are in the struct column ``row``, so their names clash with
    nothing; the facts' other columns stand beside it, after own_id and own_th.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own_th"),
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_th") == F.col("th"))
    return rows.join(facts, same, how).drop("doc_id", "th")


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], dict], schema: str, rows: int = 512) -> DataFrame:
    """mapInArrow over slices of at most ``rows`` rows, so that what a task holds at once stays small.

    ``f`` returns a dict of columns in the order of ``schema``.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: dict[str, pa.DataType] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                got = f(batch.slice(i, rows))
                cols = []
                for n in names:
                    v = got[n]
                    cols.append(v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=types.get(n) or arrow_type(schema, n)))
                yield pa.RecordBatch.from_arrays(cols, names=names)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back to the system: a worker keeps its peak between tasks otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()), "array<float>": pa.list_(pa.float32()),
}


def arrow_type(schema: str, name: str) -> pa.DataType:
    for part in schema.split(","):
        n, kind = part.split(None, 1)
        if n == name:
            return _ARROW[kind.strip()]
    raise KeyError(name)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes (null: empty), without decoding them."""
    col = batch.column(name)
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    return [x if x is not None else b"" for x in col.to_pylist()]
