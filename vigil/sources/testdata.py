"""Stand-in transaction frames derived from the driver tables.

The reference works on one wide transaction table (id, time offset in
seconds, label, numeric and categorical features). The test tables carry no
such table, so it is derived from ``events`` by plain column expressions —
every derived query therefore reads the whole ``events`` table and its work
grows with it. The same definitions exist as SQL (``TX_SQL``) for the DuckDB
oracle; both sides use exact double arithmetic (integer sums divided by a
constant) so scores agree bit for bit across engines.

Derived columns (fixed definitions):

* ``TransactionID``  = ``event_id``
* ``TransactionDT``  = whole seconds since 1970 of ``ts`` (time-zone free)
* ``amount``         = ``value``
* ``k``              = integer ``k`` of the JSON ``props``
* ``user_id``, ``hour`` (hour of ``ts``)
* ``cat_a``          = ``event_type`` (5 levels)
* ``cat_b``          = ``low`` (< 20) / ``mid`` (< 100) / ``high`` amount band
* ``f_partial``      = ``k`` as double, missing for ``view`` events (~20%)
* ``f_sparse``       = ``amount * k``, missing when ``k >= 40`` (~60%, dropped
  by the 50% missingness filter)
* ``isFraud``        = 1 for errors with ``k >= 50`` and purchases of at
  least 100, else 0
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "TransactionID"
TIME = "TransactionDT"
LABEL = "isFraud"

NUMERIC_FEATURES = ("TransactionDT", "amount", "k", "user_id", "hour", "f_partial", "f_sparse")
CATEGORICAL_FEATURES = ("cat_a", "cat_b")
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
# Contract after the 50% missingness filter drops ``f_sparse``.
CONTRACT_FEATURES = ("TransactionDT", "amount", "k", "user_id", "hour", "f_partial", "cat_a", "cat_b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide transaction frame derived from ``events`` (see module doc)."""
    ev = table(spark, sf_dir, "events")
    # parse the JSON once; the later projection reads the parsed column
    parsed = ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    k = F.col("k")
    amount = F.col("value")
    return parsed.select(
        F.col("event_id").alias(ID),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias(TIME),
        F.when(
            ((F.col("event_type") == "error") & (k >= 50))
            | ((F.col("event_type") == "purchase") & (amount >= 100)),
            1,
        )
        .otherwise(0)
        .alias(LABEL),
        amount.alias("amount"),
        k,
        F.col("user_id"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("cat_a"),
        F.when(amount < 20, "low").when(amount < 100, "mid").otherwise("high").alias("cat_b"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("double"))
        .otherwise(k.cast("double"))
        .alias("f_partial"),
        F.when(k >= 40, F.lit(None).cast("double")).otherwise(amount * k).alias("f_sparse"),
    )


# --------------------------------------------------------------------------- #
# SQL-expression scorers (pluggable scorers that both engines can evaluate)
# --------------------------------------------------------------------------- #


def champion_score(df: DataFrame | None = None) -> Column:
    """Champion: ``(k + 28*[error]) / 128``."""
    error = F.when(F.col("cat_a") == "error", 28.0).otherwise(0.0)
    return (F.col("k").cast("double") + error) / 128.0


def challenger_score(df: DataFrame | None = None) -> Column:
    """Challenger: ``(k + 28*[error] + 40*[purchase of 100+]) / 168``."""
    error = F.when(F.col("cat_a") == "error", 28.0).otherwise(0.0)
    big = F.when((F.col("cat_a") == "purchase") & (F.col("amount") >= 100), 40.0).otherwise(0.0)
    return (F.col("k").cast("double") + error + big) / 168.0


CHAMPION_THRESHOLD = 0.5

# --------------------------------------------------------------------------- #
# The same definitions as DuckDB SQL (oracle side)
# --------------------------------------------------------------------------- #

TX_SQL = """
SELECT
  event_id AS TransactionID,
  date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS TransactionDT,
  CASE WHEN (event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50)
         OR (event_type = 'purchase' AND value >= 100) THEN 1 ELSE 0 END AS isFraud,
  value AS amount,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  user_id,
  hour(ts) AS hour,
  event_type AS cat_a,
  CASE WHEN value < 20 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS cat_b,
  CASE WHEN event_type = 'view' THEN NULL
       ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) END AS f_partial,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 40 THEN NULL
       ELSE value * CAST(json_extract_string(props, '$.k') AS INTEGER) END AS f_sparse
FROM events
"""

CHAMPION_SQL = "((CAST(k AS DOUBLE) + CASE WHEN cat_a = 'error' THEN 28.0 ELSE 0.0 END) / 128.0)"
CHALLENGER_SQL = (
    "((CAST(k AS DOUBLE) + CASE WHEN cat_a = 'error' THEN 28.0 ELSE 0.0 END"
    " + CASE WHEN cat_a = 'purchase' AND amount >= 100 THEN 40.0 ELSE 0.0 END) / 168.0)"
)
