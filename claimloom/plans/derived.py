"""Catalogue rows derived from the driver's tables by SQL that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.session import dealt, table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(spark: SparkSession, sf_dir: str, sql: str, **deal: str) -> DataFrame:
    """The rows of a statement whose tables are written in braces; tables named in `deal` are dealt by that column first, where a row takes long."""
    named = [t for t in TABLES if f"{{{t}}}" in sql]
    sql = sql.replace("{", "{{").replace("}", "}}")
    for t in named:
        sql = sql.replace(f"{{{{{t}}}}}", f"{{{t}}}")
    return spark.sql(sql, **{t: dealt(table(spark, sf_dir, t), deal[t]) if t in deal else table(spark, sf_dir, t) for t in named})


def plain(sql: str) -> str:
    """The same statement over tables known by name."""
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql
