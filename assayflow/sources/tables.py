"""Parquet tables, feature bundles, fitted state and named intermediate results."""

from __future__ import annotations

import json
import uuid
import weakref
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.functions.numbers import nan_to_null


SMALL_SCAN = 8


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Read Parquet with NaN turned into NULL, so that one notion of "missing" holds everywhere."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return clean_nan(df)


def spread_out(scan: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core, for work that is heavy per row.

    Only a scan of at most SMALL_SCAN partitions (1 GB at the default split size) is dealt out, whatever the number
    of cores, so what moves has a bound; larger scans come back as they are. Meant for bare scans:
    filters and column lists still reach the reader through it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < min(cores, SMALL_SCAN + 1) else scan


def clean_nan(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats}) if floats else df


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_text_document(spark: SparkSession, document: dict, path: str) -> None:
    """Write one small JSON document to any file system Spark can reach."""
    rows = [(json.dumps(document, sort_keys=True),)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_bundle(df: DataFrame, path: str, row_id: str | list[str], features: str,
                 targets: Iterable[str], meta: dict) -> None:
    """Write the model input: row id, feature vector, targets, and their description."""
    present = [t for t in targets if t in df.columns]
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    write_table(df.select(*ids, features, *present), f"{path}/rows")
    write_text_document(df.sparkSession, {**meta, "targets": present}, f"{path}/meta")


def read_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    return spark.read.parquet(f"{path}/rows"), read_text_document(spark, f"{path}/meta")


class NamedTables:
    """Intermediate tables kept by name under one folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/named"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{self.root}/{name}")
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            raise FileNotFoundError(f"no table named {name!r} under {self.root}") from error


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; in local runs without it, one below the warehouse."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/assayflow-{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


#: Folder of every table that ``cut_lineage`` wrote, as long as the table is in use.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_SCOPES: ContextVar[tuple["Scope", ...]] = ContextVar("scopes", default=())
# A written table is never computed again, so the shuffle files behind it can go at once.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            # Arrow steps get batches of bounded size, also where texts are long.
            "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scope:
    """The intermediate tables that one job owns."""

    def __init__(self):
        self.folders: dict[str, SparkSession] = {}

    def keep(self, *tables: DataFrame) -> DataFrame:
        """Hand tables on to the scope around this one; without one they stay. Returns the first."""
        outer = _SCOPES.get()[:-1]
        for table in tables:
            folder = _FOLDERS[table]
            spark = self.folders.pop(folder, None)
            if outer and spark is not None:
                outer[-1].folders[folder] = spark
        return tables[0]


@contextmanager
def scope() -> Iterator[Scope]:
    """A block that owns the tables ``cut_lineage`` writes in it: at its end, also by an error, they are deleted.

    What the block returns must read only tables that were handed on with ``keep``.
    """
    held = Scope()
    token = _SCOPES.set((*_SCOPES.get(), held))
    try:
        yield held
    finally:
        _SCOPES.reset(token)
        for folder, spark in held.folders.items():
            _delete(spark, folder)


def free(*tables: DataFrame) -> None:
    """Delete written tables that have had their last reader; other DataFrames are left alone."""
    for table in tables:
        folder = _FOLDERS.pop(table, None)
        if folder is not None:
            for held in _SCOPES.get():
                held.folders.pop(folder, None)
            _delete(table.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Bytes that one task reads of a table written in ``small_parts``, as long as SMALL_READS holds.
PART_BYTES = 16 << 20
SMALL_READS = {"spark.sql.files.maxPartitionBytes": str(PART_BYTES)}


def cut_lineage(df: DataFrame, last: Iterable[DataFrame] = (), small_parts: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the written table.

    Unlike a checkpointed plan, a written table has a known size, which decides later join strategies. ``last`` names
    written tables whose last reader this is; they are deleted afterwards. Within a ``scope`` the table belongs
    to it from before the first file is written. ``small_parts`` is for tables whose rows grow in memory: under SMALL_READS, tasks read
    few of them, however large the table is.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    if _SCOPES.get():
        _SCOPES.get()[-1].folders[folder] = spark
    with settings(spark, _WRITING):
        (df.write.option("parquet.block.size", PART_BYTES) if small_parts else df.write).parquet(folder)
    free(*last)
    table = spark.read.schema(df.schema).parquet(folder)
    _FOLDERS[table] = folder
    return table
