"""What the operators share: table access, folds, materialised cuts, grouped batches."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

T = TypeVar("T")

#: Words are runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def make_importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if it is not installed there."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The column that ``numbered`` adds.
ROW = "_row_key"


def numbered(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``ROW``: text that no two rows share, never null, in the order of the id (null last).

    Written, so that a row has the same key each time it is read.
    """
    named = F.col(id_col)
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        # With the sign bit turned, hex digits are in the order of the numbers.
        ordered = F.lpad(F.hex(named.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    else:
        ordered = F.concat(named.cast("string"), F.lit("\0"))
    key = F.concat(F.when(named.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), ordered)), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    return cut(docs.withColumn(ROW, key))


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """Whether a row is outside the training fold; a row without an id is never learnt from."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(True))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where none is set, a local master makes one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, passing: list[str] | None = None) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back.

    Ends the lineage there, so a lost executor costs a re-read instead of a re-run.
    The table is deleted when the driver exits, or with ``passing``, to which its path is added, by ``delete``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    with _shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    atexit.register(_delete, spark, path)
    if passing is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """What runs within has this setting of Spark; the former one comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _shuffles_deleted(spark: SparkSession):
    """Shuffle files of what runs within go as soon as it has ended, not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def delete(spark: SparkSession, passing: list[str]) -> None:
    """Deletes written tables that nothing reads any more."""
    for path in passing:
        _delete(spark, path)
    passing.clear()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        return
    try:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone by now
        return


_memory: tuple[str, object] = ("", None)


def remembered(name: str, make: Callable[[], T]) -> T:
    """What this worker process keeps from task to task under ``name``; it keeps one thing at a time.

    Workers serve one stage after the other, and memories of several would add up.
    """
    global _memory
    if _memory[0] != name:
        _memory = ("", None)
        gc.collect()
        _memory = (name, make())
    return _memory[1]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal ``key`` from batches sorted by it, several groups a frame.

    Holds one batch and the group that crosses its end.
    """
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = frame[key].iloc[-1]
        cut_at = int((frame[key] == last).to_numpy().argmax())
        if cut_at == 0 and rest and rest[-1][key].iloc[-1] == last:
            rest.append(frame)
            continue
        head = [*rest, frame.iloc[:cut_at]]
        whole = pd.concat(head, ignore_index=True) if len(head) > 1 else head[0].reset_index(drop=True)
        if len(whole):
            yield whole
        rest = [frame.iloc[cut_at:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)
