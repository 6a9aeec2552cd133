"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vigil.session import ensure_checkpoint_dir, work_path

#: Characters that separate words (a fixed value of the word contracts).
WORD = r"[^\x20\x09-\x0D]+"

# Characters that lower() leaves alone or, for A-Z, lowers as wanted; any other
# character is passed through untouched by ascii_lower.
_SAFE = "\\x00-\\x7Fß-öø-ÿ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files every executor can see, so a lost executor
    costs a re-read and later passes don't recompute what is above.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Fewer rows per Arrow batch, so that long texts don't add up in a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames no longer referenced.

    They go when the driver collects garbage, which a long job with little
    driver work may not do by itself for hours.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim_memory(spark: SparkSession) -> None:
    """Give memory that a job on the driver has freed back to the system, Python's and the JVM's."""
    release(spark)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)  # glibc keeps freed pages otherwise
    except (OSError, AttributeError):
        pass  # another C library


def drop_tables(*tables: DataFrame) -> None:
    """Delete the files behind tables made by ``materialize`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        base = ensure_checkpoint_dir(spark).rstrip("/").split(":")[-1]
        jvm = spark.sparkContext._jvm
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if base in parent and "/tables/" in parent:
                path = jvm.org.apache.hadoop.fs.Path(parent)
                fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                fs.delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, in the JVM.

    ``translate`` allocates per character; this cuts the text into runs of
    characters that ``lower`` treats as wanted and the rest, and lowers the
    former only.
    """
    runs = F.regexp_extract_all(text, F.lit(f"[{_SAFE}]++|[^{_SAFE}]++"), F.lit(0))
    head = F.ascii
    return F.array_join(
        F.transform(
            runs,
            lambda s: F.when(
                (head(s) < 128) | head(s).between(0xDF, 0xF6) | head(s).between(0xF8, 0xFF),
                F.lower(s),
            ).otherwise(s),
        ),
        "",
    )


def located(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its content locator: ``_file`` and ``_row`` of each row.

    A frame that isn't a plain scan of files is written to the shared folder
    first, so that every row has a place it can be read from again.
    """
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        kept = materialize(df, name)
        return kept.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
        )


def running_rank(df: DataFrame, order: list[str], out: str, weight: Column | None = None) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (default 1) over all rows before, in ``order``.

    Range partitions are written once; only one total per partition is summed
    across partitions, so no task sees all rows.
    """
    weight = F.lit(1) if weight is None else weight
    parts = materialize(
        df.withColumn("_w", weight.cast("long"))
        .repartitionByRange(*order)
        .withColumn("_p", F.spark_partition_id()),
        "rank",
    )
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_p").agg(F.sum("_w").alias("_t")).withColumn("_o", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    )
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn("_i", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .join(offsets.select("_p", "_o"), "_p")
        .withColumn(out, F.col("_i") + F.col("_o"))
        .drop("_w", "_p", "_i", "_o")
    )
