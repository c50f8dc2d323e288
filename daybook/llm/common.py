"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Container, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space that separates words, as a Java regular expression class.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that a Python worker turns into Python objects at once.
SLICE_ROWS = 500

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or what the context was told (as in tests)."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # one machine, one process: any folder of it is shared
        found = tempfile.mkdtemp(prefix="daybook-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there from now on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, but as Parquet: smaller on disk, and read by column. Shuffle files of the query go at its end."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "table")
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete what ``stored`` has written; nothing may read the tables after that."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
    """Apply ``fn`` to slices of at most ``SLICE_ROWS`` rows of the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield fn(batch.slice(start, SLICE_ROWS))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


_kept: dict[str, object] = {}


def kept_by_worker(key: str, build: Callable[[], T]) -> T:
    """What ``build`` makes, kept by the Python worker until it needs something else.

    Workers outlive their tasks and serve one operator after another; each holds one model, automaton or
    encoding at a time.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``given_0``, ``given_1`` and so on, which clash with no other, and the name of each given one."""
    names = {c: f"given_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def beside(given: str, own: Container[str], others: Container[str] = ()) -> str:
    """The name under which a given column stands beside an operator's own ones: its name, with ``_given`` behind while that is taken."""
    name = given
    while name in own or (name != given and name in others):
        name += "_given"
    return name
