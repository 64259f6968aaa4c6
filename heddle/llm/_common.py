"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_BYTES = 4 << 20  # of an Arrow batch, on either side of the pipe to Python
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="heddle-")
    return _OWN_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; clear_scratch() removes all of them."""
    path = f"{shared_dir(spark)}/heddle-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    paths = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
    if not paths:
        atexit.register(clear_scratch, spark)
    paths.append(path)
    return path


def written(df: DataFrame, name: str, alone: bool = False) -> DataFrame:
    """Cuts lineage: writes df to the shared folder and reads it back. It outlives executors.

    alone: the shuffle files of this go as soon as it is written, and not when the driver has collected its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    try:
        if alone:
            spark.conf.set(CLEANUP, "true")
        df.write.parquet(path)
    finally:
        if alone and before is None:
            spark.conf.unset(CLEANUP)
        elif alone:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._heddle_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes what written() has left of tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_heddle_path", None)
        if path:
            _SCRATCH[df.sparkSession.sparkContext.applicationId].remove(path)
            delete_path(df.sparkSession, path)


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session's size of an Arrow batch to BATCH_BYTES, unless it is smaller; it changes no result.

    Rows of texts and sets differ in size by orders of magnitude, and the default of 64 MB is held several times over by
    an executor and its workers.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """df.mapInArrow(run, schema) whose workers give freed memory back to the system when a task ends: idle ones stay."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            return

    bounded_batches(df.sparkSession)
    return df.mapInArrow(lean, schema)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished work, which it does when the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Removes what written() has left for this application. Results that still read it must be done with."""
    try:
        for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
            delete_path(spark, path)
    except Exception:  # the session is over: nothing can be reached any more
        return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, found by exact name and cast; other columns may clash in any way.

    wanted maps a column to its type. Of columns with the very same name the first counts.
    """
    at = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    missing = [c for c in wanted if c not in at]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {df.columns}")
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[c]}").cast(t).alias(c) for c, t in wanted.items()])


def pieces(batches: Iterable[pa.RecordBatch], text: str | int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text each, so that work arrays stay small; a row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text if isinstance(text, int) else batch.schema.get_field_index(text))
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def column_at(df: DataFrame, name: str) -> int:
    """Position of the first column of exactly this name."""
    if name not in df.columns:
        raise ValueError(f"no column {name} in {df.columns}")
    return df.columns.index(name)


def rows_kept(docs: DataFrame, chooser: Callable[[], Callable[[list[str | None]], list[bool]]], text_col: str = "text", most: int = 4 << 20) -> DataFrame:
    """The rows of docs, with all their columns, whose whole text the chooser keeps. It is made once a task, and gets about `most` bytes of text at once.

    No join and no shuffle: a decision that hangs on the text alone is taken where the row is.
    """
    at = column_at(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = chooser()
        for batch in pieces(batches, at, most):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return _clashing(docs, lambda df: in_arrow(df, run, df.schema))


def rows_changed(docs: DataFrame, changer: Callable[[], Callable[[list[str | None]], list[str | None]]], text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs with the texts that the changer gives; count_col, if there, is made the new text's length."""
    at = column_at(docs, text_col)
    counted = docs.columns.index(count_col) if count_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = changer()
        for batch in pieces(batches, at, 1 << 20):
            texts = change(batch.column(at).to_pylist())
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if counted is not None:
                columns[counted] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return _clashing(docs, lambda df: in_arrow(df, run, df.schema))


def _clashing(df: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(df) under plain column names, so that names may clash."""
    return work(df.toDF(*[f"_{i}" for i in range(len(df.columns))])).toDF(*df.columns)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
