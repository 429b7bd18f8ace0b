"""What several operators of this folder share."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.session import scratch_dir, scratch_dropped

# The white space of the word pattern [^\x20\x09-\x0D]+, as bytes.split() has it.
WHITE = " \t\n\x0b\x0c\r"


def clash_free(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under names that no operator uses, and the new name of each old one."""
    names = {c: f"in_{i}_{c}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def read_documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs


def ascii_lower(text):
    """A-Z lower-cased, all other characters as they are."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


LIGHT_ROWS = 400_000


def _is_light(df: DataFrame, *arrays: str) -> bool:
    if arrays:
        size = df.agg(F.sum(sum((F.size(a) for a in arrays), F.lit(1)))).first()[0] or 0
    else:
        size = df.count()
    return size <= LIGHT_ROWS


def light(df: DataFrame, *arrays: str) -> DataFrame:
    """``df``, a written table, marked for broadcast if it is small; else left to a shuffle join.

    Narrow rows are counted; of ``arrays`` the elements are.
    """
    return F.broadcast(df) if _is_light(df, *arrays) else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, marked for a join in which no side is broadcast.

    Spark takes the size of a written table's files for its size in memory. Where values repeat, a row
    of a hundred bytes is two in Parquet, and a table that the driver cannot hold passes for small.
    """
    return df.hint("merge")


def light_or_shuffled(df: DataFrame, *arrays: str) -> DataFrame:
    """As ``light``, for a table whose values repeat: beyond the bound, Spark's own estimate does not decide."""
    return F.broadcast(df) if _is_light(df, *arrays) else shuffled(df)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame], compression: str = "snappy") -> DataFrame:
    """The written result of ``build()``.

    Rows of large binary values are better not compressed: Parquet looks at a page's size every 100 rows, and the codec
    holds whole pages outside the heap.

    Scratch that it wrote on its way is dropped, and so is what its jobs left on the executors: Spark's
    cleaner removes shuffle files and broadcasts once the driver has collected what refers to them.
    """
    path = scratch_dir(spark, name)
    with scratch_dropped(spark):
        df = build()
        schema = df.schema
        df.write.parquet(path, compression=compression)
        del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m"):
    """Jobs run within the block hand rows to Python in batches of about ``size``, for rows that hold much; the setting is put back."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def keep_batches_small(spark: SparkSession, size: str = "4m") -> None:
    """As ``small_batches``, from now on: for an operator whose result is a job that its caller runs later.

    A batch is held several times over, in the JVM and in Python, by each core of an executor.
    """
    spark.conf.set(_BATCH_SETTING, size)


WIDE_SHARE = 1000


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], members: str, total: int) -> DataFrame:
    """Inner join with ``right``, which has each key once and in ``members`` how many rows of ``left`` bear it.

    Keys that more than one in WIDE_SHARE of the ``total`` rows bear are joined apart, by a
    broadcast: there are fewer than WIDE_SHARE. So no key meets in one task with more than that
    share of the rows.
    """
    wide = F.col(members) > total // WIDE_SHARE
    spread = left.join(F.broadcast(right.where(wide)), keys)
    return spread.unionByName(left.join(F.broadcast(right.where(wide).select(*keys)), keys, "left_anti").join(right.where(~wide), keys))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: their tasks import from it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="vigilog-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
