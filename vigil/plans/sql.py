"""Oracle SQL fragments (DuckDB dialect) shared by the registered queries.

Each registered query has a plain-SQL twin the driver runs with DuckDB on the
same Parquet tables. The fragments below re-state, in SQL, the stand-in
transaction frame, the two scorers and the chronological split.
"""

from __future__ import annotations

from vigil.sources.testdata import CHALLENGER_SQL, CHAMPION_SQL, TX_SQL

TX_CTE = f"tx AS ({TX_SQL})"

# Chronological 70/15/15 split over (TransactionDT, TransactionID).
SLICED_CTE = (
    TX_CTE
    + """,
ranked AS (
  SELECT tx.*, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS rn,
         count(*) OVER () AS n_all
  FROM tx
),
sliced AS (
  SELECT * EXCLUDE (rn, n_all),
         CASE WHEN rn <= round_even(n_all * 0.7, 0) THEN 'train'
              WHEN rn <= round_even(n_all * 0.85, 0) THEN 'test'
              ELSE 'stream' END AS slice
  FROM ranked
)"""
)

# The score store used by the window / drift / corpus queries: every stream
# row scored by the champion (batch 0), then the error rows re-scored by the
# challenger (batch 1, a replayed re-score whose newest score must win).
STORE_CTE = (
    SLICED_CTE
    + f""",
store AS (
  SELECT TransactionID, {CHAMPION_SQL} AS score,
         CASE WHEN {CHAMPION_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision,
         0 AS batch_id
  FROM sliced WHERE slice = 'stream'
  UNION ALL
  SELECT TransactionID, {CHALLENGER_SQL} AS score,
         CASE WHEN {CHALLENGER_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision,
         1 AS batch_id
  FROM sliced WHERE slice = 'stream' AND cat_a = 'error'
),
latest AS (
  SELECT TransactionID, arg_max(score, batch_id) AS score
  FROM store GROUP BY TransactionID
)"""
)



def ks_tail(source: str, by: str) -> str:
    """CTEs up to ``ksp``: p-values of ``source (by, n_ref, n_cur, statistic)``.

    Smirnov's series, or up to 10,000 rows a side the exact tail: ``q`` holds
    the shares of lattice paths that have touched the bound, for the points of
    diagonal ``k`` between the bounds.
    """
    return f""",
ksl AS (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * statistic AS lam FROM {source}),
kss AS (
  SELECT *,
         CASE WHEN n_ref < 2 OR n_cur < 2 OR lam < 0.2 THEN CAST(1.0 AS DOUBLE)
              ELSE least(greatest(2.0 * list_reduce(list_transform(range(1, 101),
                     lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(CAST(-2.0 AS DOUBLE) * k * k * lam * lam)),
                     lambda a, b: a + b), 0.0), 1.0) END AS series
  FROM ksl
),
kse AS (
  WITH RECURSIVE r({by}, m, n, b, k, low, q) USING KEY ({by}) AS (
    SELECT {by}, CAST(n_ref AS BIGINT), CAST(n_cur AS BIGINT), CAST(round(statistic * n_ref * n_cur) AS BIGINT),
           CAST(0 AS BIGINT), CAST(0 AS BIGINT), [CAST(0.0 AS DOUBLE)]
    FROM kss WHERE n_ref >= 2 AND n_cur >= 2 AND greatest(n_ref, n_cur) <= 10000 AND series >= 1e-18
    UNION
    SELECT {by}, m, n, b, k + 1, lo,
           list_transform(range(lo, hi + 1), lambda i: coalesce(q[i - low], 1.0) * (i / CAST(k + 1 AS DOUBLE))
                                             + coalesce(q[i - low + 1], 1.0) * ((k + 1 - i) / CAST(k + 1 AS DOUBLE)))
    FROM (SELECT *, greatest(0, k + 1 - n, CAST(floor(((k + 1) * m - b) / CAST(m + n AS DOUBLE)) AS BIGINT) + 1) AS lo,
                 least(k + 1, m, CAST(ceil(((k + 1) * m + b) / CAST(m + n AS DOUBLE)) AS BIGINT) - 1) AS hi
          FROM r WHERE k < m + n)
  ) SELECT {by}, CASE WHEN b <= 0 THEN CAST(1.0 AS DOUBLE) ELSE coalesce(q[1], 1.0) END AS exact FROM r
),
ksp AS (
  SELECT {by}, n_ref, n_cur, statistic, least(greatest(coalesce(exact, series), 0.0), 1.0) AS p_value
  FROM kss LEFT JOIN kse USING ({by})
)"""


#: Upper tail of the standard normal distribution at a ``{z}`` from 0 to 20: the series of odd powers.
NORMAL_TAIL = (
    "greatest(0.5 - exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 800),"
    " lambda i: exp((2 * i + 1) * ln({z}) - lgamma(2 * i + 2.0) + lgamma(i + 1.0) + i * ln(2.0)))), 0.0)"
)

__all__ = ["CHALLENGER_SQL", "CHAMPION_SQL", "NORMAL_TAIL", "SLICED_CTE", "STORE_CTE", "TX_CTE", "ks_tail"]
