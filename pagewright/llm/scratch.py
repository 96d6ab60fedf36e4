"""What several operators share: written intermediates, Arrow columns as bytes, the memory of Python workers, plain words."""

from __future__ import annotations

import atexit
import ctypes
import re
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts count it; bytes.split() splits on exactly these.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a batch that a Python worker works on at once.
SLICE_ROWS = 1000
_folders: set[str] = set()
Batches = Iterator[pa.RecordBatch]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Where it is unset, a session in one process (tests) takes a
    folder of its own and a cluster is refused: its machines share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return "/tmp/checkpoints"


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may have ended; the folder is then the cluster's to clean
        pass


def store(df: DataFrame, name: str, by: str | None = None, files: int | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors. With `by`, a folder for each value of the column;
    with `files`, so many at most, for a table whose number of rows is known: each file costs a task and, on local disks, processes that set its rights.

    The tables of a session share one folder, removed when the driver's Python ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/pagewright-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{re.sub(r'[^A-Za-z0-9_]', '_', name)}-{uuid.uuid4().hex[:12]}"
    df = df.coalesce(files) if files else df
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def give_back() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run over slices of its batches, all rows in their order; at its end what it has freed is given back. Workers are kept for the tasks
    of other operators, so without that each holds the most that any of them needed.
    """

    def of(batches: Batches) -> Batches:
        try:
            yield from run(batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, max(1, batch.num_rows), SLICE_ROWS))
        finally:
            give_back()

    return of


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under names that no operator uses for its own columns, and the name that stands for each: a caller's columns may have any."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
