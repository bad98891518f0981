"""Helpers shared by the operators: tables, written intermediates, word rules."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the white space of the query contracts, as a Java/RE2/Python class body.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (tests, the local oracle
    run) gets a scratch folder; a cluster without it is an error, because a
    machine-local folder is not visible to the other machines.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="ruleforge-llm-")
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_kept(spark: SparkSession, keep: bool) -> Iterator[None]:
    """Unless ``keep``, the shuffle files of what is run inside go as soon as each query is through; with ``keep``
    the session decides. For queries whose whole result is written, since nothing reads the files again."""
    if keep:
        yield
        return
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the
    lineage, so an executor lost later costs a read and not the whole job.
    With ``tidy`` the write's shuffle files go once it is done."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-tables/{label}-{uuid.uuid4().hex}"
    with shuffles_kept(spark, not tidy):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of ``saved`` tables. Only for tables that nothing still to be run reads: what was made from
    them must have been written itself."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-tables/" not in folder:
                raise ValueError(f"not a saved table: {folder}")
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def saved_parts(spark: SparkSession, parts: Iterable[DataFrame], schema: T.StructType, label: str,
                tidy: bool = False) -> DataFrame:
    """The rows of all ``parts``, each written before the next one is asked for, read as one table."""
    path = f"{shared_dir(spark)}/llm-tables/{label}-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    with shuffles_kept(spark, not tidy):
        for part in parts:
            part.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable ``checkpoint()`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a saved table of narrow rows) marked for broadcast if it has at most ``rows`` rows; else as it is,
    for an ordinary join that adaptive execution may split. Either way the result is the same."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so clashing extra columns cannot matter."""
    return docs.select("doc_id", *more, F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """True for the rows whose label must not be learnt: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small pieces of an Arrow batch, so that only few texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def utf8_lists(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def worker_state(key: object, make: Callable):
    """``make()``, once for each Python worker: compiled vocabularies and bounded caches
    outlive the task. The two used last are kept; losing a worker only costs making them again."""
    store = sys.modules.setdefault("_ruleforge_llm_worker", types.ModuleType("_ruleforge_llm_worker"))
    kept = store.__dict__.setdefault("kept", {})
    value = kept.pop(key) if key in kept else make()
    kept[key] = value
    while len(kept) > 2:
        del kept[next(iter(kept))]
    return value


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
