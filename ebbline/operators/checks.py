"""Column, key and reference checks. Violations come back as rows; none means sound."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> DataFrame:
    """Fail before any action when a column is missing."""
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"{what} must contain {missing}. Found: {df.columns}")
    return df


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def column_report(df: DataFrame, names: Iterable[str], what: str) -> DataFrame:
    """One row: the table, its number of rows, and the required columns that it lacks, comma-separated."""
    lacks = ",".join(missing_columns(df, names))
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(what).alias("table_name"), "n_rows", F.lit(lacks).alias("missing_columns"))


def duplicate_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Key values that occur more than once, with the number of rows."""
    label = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
        .select(F.lit(check).alias("check_name"), label.alias("key_value"), "n_rows")
    )


def null_keys(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Rows whose key is not complete, counted."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return (
        df.filter(incomplete)
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 0")
        .select(F.lit(check).alias("check_name"), F.lit(None).cast("string").alias("key_value"), "n_rows")
    )


def key_violations(df: DataFrame, table: str, keys: list[tuple[list[str], bool]]) -> DataFrame:
    """Repeated and incomplete values of several keys in one pass: ``(check_name, key_value, n_rows)``.

    Each key comes with whether its columns may be NULL; then NULLs are values like any other.
    """

    def entry(names: list[str], nullable: bool):
        check = f"{table}({','.join(names)})"
        parts = [F.col(n).cast("string") for n in names]
        complete = F.lit(True)
        for n in names:
            complete = complete & F.col(n).isNotNull()
        value = F.concat_ws("|", *parts)
        if nullable:
            parts = [F.coalesce(p, F.lit("")) for p in parts]
            return F.struct(F.lit(f"unique {check}").alias("check_name"), F.concat_ws("|", *parts).alias("key_value"))
        name = F.when(complete, f"unique {check}").otherwise(f"not null {check}")
        return F.struct(name.alias("check_name"), F.when(complete, value).alias("key_value"))

    values = df.select(F.explode(F.array(*[entry(*k) for k in keys])).alias("k")).select("k.*")
    counted = values.groupBy("check_name", "key_value").agg(F.count("*").alias("n_rows"))
    return counted.filter("n_rows > 1 or key_value is null")


def orphans(child: DataFrame, parent: DataFrame, key: str, check: str) -> DataFrame:
    """Key values of the child that the parent does not have, with the number of rows.

    The child is reduced to its distinct keys before the join, so a hot key is one row.
    """
    return (
        child.groupBy(key)
        .agg(F.count("*").alias("n_rows"))
        .join(parent.select(key), key, "left_anti")
        .select(F.lit(check).alias("check_name"), F.col(key).cast("string").alias("key_value"), "n_rows")
    )
