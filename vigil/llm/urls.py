"""URL filter: longest fitting rule, else a character language-model ratio.

URLs that a rule accepts or rejects train two variable-order Markov models of
characters (contexts of 0 to 4 characters, Witten-Bell interpolation). Any
other URL is judged by the difference of the two log-likelihoods over its
length, against a threshold calibrated on held-out rule-labelled URLs. All of
it is DataFrame work: counts and probabilities are tables of distinct grams,
scores a join of URL positions with the longest grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize

#: The contract's rules (fixed values): verdict and host/path prefix.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ORDER = 4
START, END = "\x02", "\x03"
#: One URL in so many is held out for calibration.
HELD = 5
#: Scores are calibrated in steps of 1/STEPS between -LIMIT and LIMIT.
STEPS, LIMIT = 200, 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits a host or one of its parents, and the path's start; null if none."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        at = rule.index("/")
        name, prefix = rule[:at], rule[at:]
        here = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        fits.append(F.when(here, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def _gram_probabilities(grams: DataFrame) -> DataFrame:
    """``(gram, ratio)``: log of the last character's accepted over rejected probability.

    ``grams`` has the distinct longest grams with their counts ``a`` and ``r``
    in either class. Each order interpolates with the one below it.
    """
    below = None
    for m in range(ORDER + 1):
        counts = (
            grams.select(F.expr(f"right(gram, {m + 1})").alias("g"), "a", "r").groupBy("g").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        )
        counts = materialize(counts, "url-counts")
        contexts = (
            counts.groupBy(F.expr(f"left(g, {m})").alias("c"))
            .agg(
                F.sum("a").alias("na"), F.sum("r").alias("nr"),
                F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"),
            )
        )
        rows = counts.withColumn("c", F.expr(f"left(g, {m})")).join(contexts, "c")
        if below is None:
            rows = rows.withColumns({"la": F.lit(1 / 256), "lr": F.lit(1 / 256)})
        else:
            rows = rows.withColumn("s", F.expr(f"right(g, {m})")).join(below, "s")

        def mixed(n: str, total: str, kinds: str, low: str) -> Column:
            return F.when(F.col(total) > 0, (F.col(n) + F.col(kinds) * F.col(low)) / (F.col(total) + F.col(kinds))).otherwise(F.col(low))

        below = materialize(
            rows.select(F.col("g").alias("s"), mixed("a", "na", "ta", "la").alias("la"), mixed("r", "nr", "tr", "lr").alias("lr")),
            "url-order",
        )
    return below.select(F.col("s").alias("gram"), (F.log("la") - F.log("lr")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The score that best separates held-out accepted from rejected URLs (balanced accuracy).

    Only a histogram of at most 2 x LIMIT x STEPS cells reaches the driver.
    """
    place = F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) * STEPS).cast("int")
    cells = scored.groupBy(place.alias("at")).agg(F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("r")).collect()
    accepted, rejected = sum(c["a"] for c in cells), sum(c["r"] for c in cells)
    if not accepted or not rejected:
        return 0.0
    best, cut, left_a, left_r = -1.0, 0.0, 0, 0
    ordered = sorted(cells, key=lambda c: c["at"])
    for i, c in enumerate([*ordered, None]):
        value = (accepted - left_a) / accepted + left_r / rejected
        if value > best:
            before = ordered[i - 1]["at"] if i else -LIMIT * STEPS
            best, cut = value, ((c["at"] if c else LIMIT * STEPS) + before) / 2 / STEPS
        if c:
            left_a, left_r = left_a + c["a"], left_r + c["r"]
    return cut


def judge_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES,
) -> DataFrame:
    """One row per input row: ``id, host, path, rule, verdict, score``.

    Null URLs and URLs without ``://`` have an empty host and path and are
    judged like any other. If either class has no labelled URL the models can
    say nothing and unlabelled URLs are allowed. Repeated rows are judged
    alike; an empty table gives no rows; other columns aren't read.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", host.alias("host"), path.alias("path"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("fit", fit).select(
        F.monotonically_increasing_id().alias("row"), "id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("label"),
        F.concat(F.lit(START * ORDER), F.lower(F.concat("host", "path")), F.lit(END)).alias("chars"),
    )
    urls = materialize(
        # one URL in five is held out for calibration, the same wherever it recurs
        urls.withColumn("held", F.conv(F.substring(F.md5("chars"), 1, 8), 16, 10).cast("long") % HELD == 0), "urls"
    )
    known = {r["label"] for r in urls.filter("label is not null").select("label").distinct().collect()}
    if known < {"allow", "block"}:
        return urls.select("id", "host", "path", "rule", F.coalesce("label", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    gram = F.expr(f"substring(chars, at, {ORDER + 1})")
    spots = urls.select(
        "row", "label", "held", "chars", F.explode(F.sequence(F.lit(1), F.length("chars") - ORDER)).alias("at")
    ).select("row", "label", "held", gram.alias("gram"))
    train = lambda c: F.coalesce((F.col("label") == c) & ~F.col("held"), F.lit(False))
    grams = materialize(
        spots.groupBy("gram").agg(F.count_if(train("allow")).alias("a"), F.count_if(train("block")).alias("r")), "url-grams"
    )
    ratios = materialize(_gram_probabilities(grams), "url-ratios")
    wanted = spots.filter("label is null or held").select("row", "gram")
    scores = materialize(wanted.join(ratios, "gram").groupBy("row").agg(F.avg("ratio").alias("score")), "url-scores")
    joined = urls.join(scores, "row", "left")
    cut = _threshold(joined.filter("label is not null and score is not null").select("score", (F.col("label") == "allow").alias("good")))
    judged = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return joined.select("id", "host", "path", "rule", F.coalesce("label", judged).alias("verdict"), "score")


def query(pages: DataFrame) -> DataFrame:
    return judge_urls(pages).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same models as one SQL statement, an order of the models per step."""
    fits = "\n".join(
        f"WHEN (host = '{rule[: rule.index('/')]}' OR ends_with(host, '.{rule[: rule.index('/')]}')) "
        f"AND starts_with(path, '{rule[rule.index('/'):]}') THEN ['{rule}', '{verdict}']"
        for verdict, rule in sorted(RULES, key=lambda r: -len(r[1]))
    )
    steps = []
    for m in range(ORDER + 1):
        low = f"JOIN p{m - 1} AS low ON right(c.g, {m}) = low.g" if m else "CROSS JOIN (SELECT 1 / 256.0::DOUBLE AS la, 1 / 256.0::DOUBLE AS lr) AS low"
        steps.append(f"""c{m} AS (SELECT right(gram, {m + 1}) AS g, sum(a) AS a, sum(r) AS r FROM grams GROUP BY 1),
x{m} AS (SELECT left(g, {m}) AS c, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr FROM c{m} GROUP BY 1),
p{m} AS (SELECT c.g, CASE WHEN na > 0 THEN (a + ta * la) / (na + ta) ELSE la END AS la,
  CASE WHEN nr > 0 THEN (r + tr * lr) / (nr + tr) ELSE lr END AS lr
  FROM c{m} AS c JOIN x{m} AS x ON left(c.g, {m}) = x.c {low})""")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rest AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT n, page_id, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (
  SELECT *, CASE {fits} END AS fit,
         repeat(chr(2), {ORDER}) || lower(host || path) || chr(3) AS chars FROM split
), urls AS (
  SELECT *, fit[1] AS rule, fit[2] AS label, ('0x' || substr(md5(chars), 1, 8))::BIGINT % {HELD} = 0 AS held FROM ruled
), known AS (
  SELECT count(DISTINCT label) = 2 AS two_classes FROM urls
), spots AS (
  SELECT n, label, held, substr(chars, i, {ORDER + 1}) AS gram
  FROM (SELECT *, unnest(range(1, length(chars) - {ORDER} + 1)) AS i FROM urls)
), grams AS (
  SELECT gram, count(*) FILTER (label = 'allow' AND NOT held) AS a, count(*) FILTER (label = 'block' AND NOT held) AS r
  FROM spots GROUP BY 1
), {", ".join(steps)}, scores AS (
  SELECT n, avg(ln(la) - ln(lr)) AS score FROM spots JOIN p{ORDER} ON gram = g WHERE label IS NULL OR held GROUP BY 1
), cells AS (
  SELECT round(greatest(-{LIMIT}, least({LIMIT}, score)) * {STEPS})::INT AS cell,
         count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS r
  FROM scores JOIN urls USING (n) WHERE label IS NOT NULL GROUP BY 1
  UNION ALL SELECT {LIMIT * STEPS + 1}, 0, 0
), sums AS (
  SELECT cell, coalesce(lag(cell) OVER w, {-LIMIT * STEPS}) AS before, sum(a) OVER () AS accepted, sum(r) OVER () AS rejected,
         sum(a) OVER w - a AS left_a, sum(r) OVER w - r AS left_r
  FROM cells WINDOW w AS (ORDER BY cell)
), best AS (
  SELECT CASE WHEN accepted = 0 OR rejected = 0 THEN 0.0::DOUBLE
              ELSE (least(cell, {LIMIT * STEPS}) + before) / 2.0::DOUBLE / {STEPS} END AS cut
  FROM sums ORDER BY (accepted - left_a) / accepted + left_r / rejected DESC, cell LIMIT 1
)
SELECT page_id, host, path, rule,
       CASE WHEN label IS NOT NULL THEN label WHEN NOT two_classes THEN 'allow'
            WHEN score >= (SELECT cut FROM best) THEN 'allow' ELSE 'block' END AS verdict
FROM urls CROSS JOIN known LEFT JOIN scores USING (n)
"""


ORACLE_SQL = _oracle()
