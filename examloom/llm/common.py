"""Helpers that several corpus operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fresh(df: DataFrame, base: str) -> str:
    """A column name that starts with ``base`` and clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineages: the one the session names, else (local runs, tests) a new temporary one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found is None:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if found is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            found = tempfile.mkdtemp(prefix="examloom-checkpoints-")
        sc.setCheckpointDir(found)
    return found


#: Bytes that one Arrow batch between Spark and Python holds while a table is cut off: very long texts come in smaller batches.
BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_LIMIT, None)
    spark.conf.set(_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LIMIT)
        else:
            spark.conf.set(_LIMIT, before)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so lost executors don't undo it."""
    checkpoint_dir(df.sparkSession)
    with _small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Like ``cut``, but as compressed Parquet: for tables with texts or many rows, which a checkpoint would keep at their full size. The folder is added to ``paths``, for the caller to remove."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    with _small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_tables: dict[Any, Any] = {}


def worker_tables(key: Any, make: Callable[[], Any]) -> Any:
    """Large tables of one operator, made once in each Python worker; those of any other are let go, as Spark uses its workers again for whatever comes next."""
    if key not in _tables:
        free_tables()
        _tables[key] = make()
    return _tables[key]


def free_tables() -> None:
    """Lets go of what other operators have left in this Python worker, cycles included."""
    if _tables:
        _tables.clear()
        gc.collect()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")



def map_in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` for columns of any name, dots included."""
    names, given = df.columns, [f"c{i}" for i in range(len(df.columns))]
    made = [f"c{i}" for i in range(len(schema.fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=made)

    plain = T.StructType([T.StructField(m, f.dataType, f.nullable) for m, f in zip(made, schema.fields)])
    return df.toDF(*given).mapInArrow(run, plain).toDF(*schema.names)


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many tasks as there are cores; one that has enough stays as it is, unshuffled."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
