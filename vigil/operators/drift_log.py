"""ST6: drift over a growing log, from summaries of its batches.

A drift pass over rows reads the whole window every time. Here each batch is
summarised once, when it comes: how many of its rows have each value of a
numeric feature (the fine summary), how many fall in each bin of the reference's
quantiles, and how many have each category (the coarse summary). Summaries add
up, so a window is the sum of its batches' coarse summaries, a few hundred rows
per feature and batch.

The KS statistic stays exact. The ECDFs are known at the bins' edges; within a
bin the gap is at most ``max(F_ref(right) - F_cur(left), F_cur(right) -
F_ref(left))``. Only bins where that exceeds the largest gap at an edge are
looked up in the fine summaries, which are sorted by feature and bin, so that
the lookup is pushed down to the Parquet scan.

Rows that a later batch replaces are passed with it and counted as -1. Batches
are committed through the same log as the score store's, and known by writer and
number, so a replayed batch is not added twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.ordered import prefix_sums
from vigil.functions.stats import EXACT_ROWS
from vigil.operators import drift
from vigil.operators.manifest import COMPACT_EVERY, Manifest
from vigil.session import path_exists, written

#: Bins of a numeric feature (2 ** STEPS) and the accuracy of their edges, quantiles of the reference's distinct values.
STEPS, ACCURACY = 8, 10_000
FINE = "batch long, f int, bin int, value double, n long"
COARSE = "batch long, f int, bin int, category string, n long"
WRITER = "drift"


def bin_of(edges: Column, value: Column) -> Column:
    """The number of ``edges`` (ascending) below ``value``, by halving."""
    size = F.size(edges)

    def halve(low: Column, step: Column) -> Column:
        to = low + step
        return F.when((to <= size) & (F.get(edges, to - 1) < value), to).otherwise(low)

    steps = F.array(*[F.lit(1 << s) for s in range(STEPS, -1, -1)])
    return F.aggregate(steps, F.lit(0), halve)


class DriftLog:
    """Summaries of a reference and of batches at ``path``, for one list of features."""

    def __init__(
        self, spark: SparkSession, path: str, numeric: Sequence[str], categorical: Sequence[str], *, score_col: str = "score"
    ) -> None:
        self.spark, self.path, self.score_col = spark, path.rstrip("/"), score_col
        self.features = [*numeric, *categorical]
        self.numeric, self.categorical = [*numeric, score_col], list(categorical)
        self.names = [*self.numeric, *self.categorical]
        self.coarse, self.fine = Manifest(spark, f"{self.path}/coarse"), Manifest(spark, f"{self.path}/fine")

    # -- writing ----------------------------------------------------------- #

    def set_reference(self, reference: DataFrame) -> None:
        """Summarise the reference half, whose quantiles bound the bins of all batches."""
        if path_exists(self.spark, f"{self.path}/reference"):
            raise ValueError(f"{self.path} has a reference; another one needs a log of its own")
        counts = written(self._counted(reference.withColumn("_sign", F.lit(1))), "reference-counts")
        probabilities = [i / (1 << STEPS) for i in range(1, 1 << STEPS)]
        quantiles = F.percentile_approx("value", probabilities, ACCURACY)  # of the distinct values: bins only steer the lookup
        edges = counts.filter("category is null").groupBy("f").agg(F.array_sort(F.array_distinct(quantiles)).alias("edges"))
        edges.coalesce(1).write.parquet(f"{self.path}/edges")
        binned = self._binned(counts, -1)
        self._fine_rows(binned).write.parquet(f"{self.path}/reference-fine")
        self._coarse_rows(binned).write.parquet(f"{self.path}/reference")  # last: it says that the rest is there

    def append(
        self, rows: DataFrame, batch: int, *, replaced: DataFrame | None = None, writer: str = WRITER, compact_every: int = COMPACT_EVERY
    ) -> bool:
        """Add a batch of rows with features and score; False if it is in the log already.

        ``replaced``: rows of earlier batches that these rows stand for now.
        """
        if self.coarse.committed(writer, batch):
            return False
        signed = rows.select(*self._columns(), F.lit(1).alias("_sign"))
        if replaced is not None:
            signed = signed.unionByName(replaced.select(*self._columns(), F.lit(-1).alias("_sign")))
        binned = written(self._binned(self._counted(signed), batch), "batch-counts")
        # the fine summary first: a batch counts from the commit of the coarse one
        for log, part in ((self.fine, self._fine_rows(binned)), (self.coarse, self._coarse_rows(binned))):
            if not log.committed(writer, batch):
                entry = log.commit(*log.stage(part), writer, batch)
                if entry is not None and log.behind(entry) >= compact_every:
                    log.compact(lambda fresh, log=log: self._read(log, fresh))
        return True

    def sink(self, features: Callable[[DataFrame], DataFrame], *, writer: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function: each micro-batch, as ``features`` makes its rows, is a batch."""
        return lambda batch, batch_id: self.append(features(batch), batch_id, writer=writer) and None

    def _columns(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in self.names]

    def _counted(self, signed: DataFrame) -> DataFrame:
        cells = drift.feature_cells(signed.select(*self._columns(), "_sign"), self.numeric, self.categorical, ["_sign"])
        return cells.groupBy("f", "value", "category").agg(F.sum("_sign").cast("long").alias("n"))

    def _binned(self, counts: DataFrame, batch: int) -> DataFrame:
        edges = self.spark.read.schema("f int, edges array<double>").parquet(f"{self.path}/edges")
        placed = counts.join(edges, "f", "left")  # one row per feature: its size lets Spark choose to broadcast it
        place = F.when(F.col("category").isNull(), bin_of(F.coalesce("edges", F.array().cast("array<double>")), F.col("value")))
        return placed.filter("n <> 0").select(F.lit(batch).cast("long").alias("batch"), "f", place.cast("int").alias("bin"), "value", "category", "n")

    def _fine_rows(self, binned: DataFrame) -> DataFrame:
        fine = binned.filter("category is null").select("batch", "f", "bin", "value", "n")
        return fine.repartitionByRange("f", "bin", "value").sortWithinPartitions("f", "bin", "value")

    def _coarse_rows(self, binned: DataFrame) -> DataFrame:
        return binned.groupBy("batch", "f", "bin", "category").agg(F.sum("n").alias("n")).coalesce(1)

    # -- reading ----------------------------------------------------------- #

    def _read(self, log: Manifest, folders: Iterable[str]) -> DataFrame:
        schema = FINE if log is self.fine else COARSE
        paths = [f"{log.path}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _window(self, log: Manifest, first: int | None, last: int | None) -> DataFrame:
        parts, fresh = log.snapshot()
        rows = self._read(log, [*parts, *fresh])
        rows = rows if first is None else rows.filter(F.col("batch") >= first)
        return rows if last is None else rows.filter(F.col("batch") <= last)

    def _sides(self, reference: DataFrame, window: DataFrame, by: Sequence[str]) -> DataFrame:
        half = lambda df, ref: df.select(*by, (F.col("n") * ref).alias("n_ref"), (F.col("n") * (1 - ref)).alias("n_cur"))
        both = half(reference, 1).unionByName(half(window, 0))
        return both.groupBy(*by).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")).filter("n_ref <> 0 or n_cur <> 0")

    def statistics(self, first: int | None = None, last: int | None = None) -> tuple[DataFrame, list[tuple[int, int]], DataFrame]:
        """KS statistics per feature, the bins that had to be looked up, and all coarse counts.

        The window has the batches from ``first`` to ``last``, both included.
        """
        reference = self.spark.read.schema(COARSE).parquet(f"{self.path}/reference")
        counts = written(self._sides(reference, self._window(self.coarse, first, last), ["f", "bin", "category"]), "coarse-counts")
        up_to = Window.partitionBy("f").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # a few hundred rows
        of_all = Window.partitionBy("f")
        bins = counts.filter("category is null").select(
            "f", "bin", "n_ref", "n_cur",
            *[F.sum(f"n_{s}").over(up_to).alias(f"cum_{s}") for s in ("ref", "cur")],
            *[F.sum(f"n_{s}").over(of_all).alias(f"tot_{s}") for s in ("ref", "cur")],
        )
        share = lambda n, s: F.try_divide(n, F.col(f"tot_{s}"))
        left = {s: share(F.col(f"cum_{s}") - F.col(f"n_{s}"), s) for s in ("ref", "cur")}
        right = {s: share(F.col(f"cum_{s}"), s) for s in ("ref", "cur")}
        bins = written(
            bins.withColumns(
                {
                    "gap": F.abs(right["ref"] - right["cur"]),
                    "most": F.greatest(right["ref"] - left["cur"], right["cur"] - left["ref"]),
                }
            ).withColumn("best", F.max("gap").over(of_all)),
            "drift-bins",
        )
        edges = bins.groupBy("f").agg(F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"), F.max("gap").alias("d"))
        open_bins = bins.filter("most > best")
        looked_up = sorted((r.f, r.bin) for r in open_bins.select("f", "bin").collect())  # 256 per feature at most
        if looked_up:
            wanted = None
            for f in sorted({f for f, _ in looked_up}):
                one = (F.col("f") == f) & F.col("bin").isin([b for g, b in looked_up if g == f])
                wanted = one if wanted is None else wanted | one
            fine = self._sides(
                self.spark.read.schema(FINE).parquet(f"{self.path}/reference-fine").filter(wanted),
                self._window(self.fine, first, last).filter(wanted),
                ["f", "bin", "value"],
            )
            before = open_bins.select("f", "bin", *[(F.col(f"cum_{s}") - F.col(f"n_{s}")).alias(f"low_{s}") for s in ("ref", "cur")], "tot_ref", "tot_cur")
            inside = prefix_sums(fine, ["value"], ["n_ref", "n_cur"], by=["f", "bin"]).join(before, ["f", "bin"])
            at = {s: share(F.col(f"low_{s}") + F.col(f"cum_n_{s}"), s) for s in ("ref", "cur")}
            found = inside.groupBy("f").agg(F.max(F.abs(at["ref"] - at["cur"])).alias("inner_d"))
            edges = edges.join(found, "f", "left").withColumn("d", F.greatest("d", "inner_d")).drop("inner_d")
        enough = (F.col("n_ref") >= 2) & (F.col("n_cur") >= 2)
        stats = edges.select(
            drift.named(self.names), F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"),
            F.when(enough, F.coalesce("d", F.lit(0.0))).otherwise(F.lit(0.0)).alias("statistic"),
        )
        return stats, looked_up, counts

    def metrics(self, first: int | None = None, last: int | None = None, *, exact_rows: int = EXACT_ROWS) -> DataFrame:
        """M8's metrics of the window against the reference, without reading a row of either."""
        stats, _, counts = self.statistics(first, last)
        categories = counts.filter("category is not null").select(drift.named(self.names), F.lit(None).cast("double").alias("value"), "category", "n_ref", "n_cur")
        return drift.metrics_of(
            categories, self.numeric, self.categorical, self.features, score_col=self.score_col, exact_rows=exact_rows, statistics=stats
        )


__all__ = ["DriftLog", "bin_of"]
