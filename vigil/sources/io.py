"""Scans and sinks.

Schemas are declared at every read (no inference pass over the data), CSV
reads are PERMISSIVE so a malformed field becomes NULL for the contract's
quarantine to report, and every sink writes through the cluster file system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.errors import ContractError


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with a declared schema, columns matched by name.

    The header may list the columns in any order; a missing or extra column
    raises :class:`ContractError`. Malformed fields come out NULL.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns
    absent, extra = [c for c in declared.names if c not in header], [c for c in header if c not in declared.names]
    if absent or extra:
        raise ContractError(f"CSV header of {path}: columns absent {absent}, not declared {extra}")
    return (
        spark.read.schema(T.StructType([declared[c] for c in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .select(*[f"`{c}`" for c in declared.names])
    )


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """S1 for raw input: every column as text, for row-level type checks."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, path, schema)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Header CSV (one folder of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (column pruning and filter pushdown by Catalyst)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """S3: Parquet sink (overwrite by default)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def parse_json_payloads(
    df: DataFrame,
    json_col: str,
    schema: T.StructType,
    *,
    keep: Sequence[str] = (),
    findings: bool = False,
) -> DataFrame:
    """JSON objects -> typed columns plus contract findings.

    Adds ``unknown_keys`` (keys outside the schema, ``; ``-joined), and
    ``bad_values`` (fields present in the text but not parsable to the
    declared type). With ``findings`` it also adds ``missing_keys`` (schema
    fields the text lacks) and ``malformed`` (text that is no JSON object).
    """
    names = [f.name for f in schema.fields]
    parsed = F.from_json(F.col(json_col), schema)
    raw = F.from_json(F.col(json_col), T.MapType(T.StringType(), T.StringType()))
    keys = F.json_object_keys(F.col(json_col))
    unknown = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*[F.lit(n) for n in names]))
    bad = F.array_compact(
        F.array(
            *[
                F.when(raw[f.name].isNotNull() & parsed[f.name].isNull(), F.lit(f.name))
                for f in schema.fields
            ]
        )
    )
    return df.select(
        *keep,
        *[parsed[n].alias(n) for n in names],
        F.concat_ws("; ", F.array_sort(unknown)).alias("unknown_keys"),
        F.concat_ws("; ", bad).alias("bad_values"),
        *(
            [
                F.concat_ws("; ", F.array_except(F.array(*[F.lit(n) for n in names]), keys)).alias("missing_keys"),
                (F.col(json_col).isNotNull() & keys.isNull()).alias("malformed"),
            ]
            if findings
            else []
        ),
    )


def json_findings(df: DataFrame, json_col: str, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """S7 with one parse: typed columns and what is wrong with each payload.

    The text becomes a VARIANT once; fields, keys and findings are read from it.
    ``malformed``: text that is no JSON object; ``missing_keys``: fields of the
    schema that are absent or null; ``unknown_keys``: keys beyond the schema;
    ``bad_values``: fields whose value isn't of the type. Lists are in order and
    ``; ``-joined. A NULL payload has no findings but its missing keys.
    """
    names = [f.name for f in schema.fields]
    parsed = df.select(*keep, F.col(json_col).isNotNull().alias("_given"), F.try_parse_json(json_col).alias("_v"))
    fields = F.expr("try_variant_get(_v, '$', 'map<string, variant>')")
    parsed = parsed.withColumn("_m", fields)

    def at(name: str, kind: str):
        path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        return F.try_variant_get(F.when(F.col("_m").isNotNull(), F.col("_v")), path, kind)

    value = {f.name: at(f.name, f.dataType.simpleString()) for f in schema.fields}
    present = {n: at(n, "string").isNotNull() | at(n, "variant").isNotNull() & ~F.coalesce(F.is_variant_null(at(n, "variant")), F.lit(True)) for n in names}
    keys = F.coalesce(F.map_keys("_m"), F.array().cast("array<string>"))
    listed = lambda cond: F.concat_ws("; ", F.array_compact(F.array(*[F.when(cond(n), F.lit(n)) for n in sorted(names)])))
    return parsed.select(
        *keep,
        *[value[n].alias(n) for n in names],
        (F.col("_given") & F.col("_m").isNull()).alias("malformed"),
        listed(lambda n: ~present[n]).alias("missing_keys"),
        F.concat_ws("; ", F.array_sort(F.array_except(keys, F.array(*[F.lit(n) for n in names])))).alias("unknown_keys"),
        listed(lambda n: present[n] & value[n].isNull()).alias("bad_values"),
    )


def payload_schema(df: DataFrame, json_col: str) -> str:
    """The schema that all parsable payloads share, to compare between windows: drift of the key set."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json(json_col))).first()[0]


def write_report_json(metrics: DataFrame, path: str) -> None:
    """The drift metrics table as JSON lines (one small file)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_report_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_submission(scored: DataFrame, path: str, *, id_col: str = "TransactionID", score_col: str = "score") -> None:
    """``(id, score)`` submission file for an unlabeled table."""
    write_csv(scored.select(id_col, score_col), path)
