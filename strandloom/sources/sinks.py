"""Sinks: several tables that appear together, quarantines, answer caches, statistics."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources.files import Table, typed


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def as_text(df: DataFrame, table: Table) -> DataFrame:
    """Cells as text: lists joined by commas, booleans as 0 or 1, nulls empty."""
    kinds = dict(df.dtypes)
    cell = lambda c: F.array_join(c, ",") if kinds[c].startswith("array") else F.col(c).cast("int").cast("string") if kinds[c] == "boolean" else F.col(c).cast("string")
    return df.select(*(F.coalesce(cell(c), F.lit("")).alias(c) for c in table.columns))


def write_tables(writes: list[tuple[DataFrame, Table, str]], compression: str = "none") -> None:
    """Check every table, write all beside their places, then move them in order, so the last one marks completion."""
    staged = []
    for df, table, path in writes:
        text = as_text(df, table)
        typed(text, table)
        text.write.mode("overwrite").option("compression", compression).csv(f"{path}.tmp", sep="\t", header=True, quote="", escape="", emptyValue="")
        staged.append((df.sparkSession, path))
    for spark, path in staged:
        new, fs = _fs(spark, f"{path}.tmp")
        old, _ = _fs(spark, path)
        if fs.exists(old):
            fs.delete(old, True)
        fs.rename(new, old)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Rejected rows with their reason, never dropped silently."""
    df.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(path)


def append_answers(df: DataFrame, path: str) -> None:
    """``key, value`` answers as one more file of a cache; earlier files are never touched."""
    df.select(F.concat(F.col("key"), F.lit("\t"), F.regexp_replace("value", r"[\t\r\n]+", " ")).alias("line")).write.mode("append").text(path)


def write_statistics(spark: SparkSession, row: dict, path: str) -> None:
    """A small JSON document, replaced at once."""
    new, fs = _fs(spark, path + ".tmp")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(row, indent=2, sort_keys=True).encode()))
    out.close()
    old, _ = _fs(spark, path)
    fs.delete(old, False)
    fs.rename(new, old)


def scorecard_json(df: DataFrame) -> tuple[str, bool]:
    """``condition, score`` rows as a JSON document, and whether all passed."""
    rows = {r.condition: {"0": r.score} for r in df.orderBy("condition").collect()}  # one row per condition
    return json.dumps(rows), all(v["0"] >= 1 for v in rows.values())
