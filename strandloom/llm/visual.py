"""Texts that look the same (problem 6): the form as a column, and pairs of rows that look alike.

Null texts belong to no pair and keep a null form. Equal strings are never a
pair. Rows repeated with the same key count once. Extra columns are ignored
or, in ``with_form``, carried along.

A group of texts that look the same is handled whole: all its different strings
are paired with one another, in chunks of at most ``CHUNK`` rows against the
group, so a group of any size is many tasks' work. Of one identical string, up
to ``COPIES`` rows take part; every further copy is paired with the first row
of one other string, and ``alike_classes`` names its class, so no row and no
link between different strings is lost.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm import textform
from strandloom.runtime import Scratch, spread

COPIES, CHUNK = 32, 2_000


def _form(text: pa.Array) -> pa.Array:
    return textform.one_form(text)


def form(column: Column | str) -> Column:
    """The one form of a text column. Null gives null, blanks give an empty text."""
    return F.arrow_udf(_form, T.StringType())(column)


def with_form(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the form of ``column`` as ``out``; an existing column of that name is replaced."""
    return df.withColumn(out, form(F.col(column)))


def _groups(df: DataFrame, key: str, text: str, scratch: Scratch) -> tuple[DataFrame, list[str], list[str]]:
    """``f, g, t, key`` of the rows whose look two or more strings share, and the columns that name a look and a string."""
    rows = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null"))
    # 128 bits of the form name a group, 64 more tell its strings apart
    look = form(F.col("text"))
    hashed = rows.select("key", F.xxhash64("text").alias("t"), look.alias("form")).select("key", "t", F.xxhash64("form").alias("f"), F.xxhash64(F.lit("second"), "form").alias("g"))
    hashed = scratch.save(hashed, "hashed")
    group, string = ["f", "g"], ["f", "g", "t"]
    several = hashed.groupBy(group).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select(group)
    return scratch.save(hashed.join(several, group, "left_semi").dropDuplicates([*string, "key"]), "inside"), group, string


def alike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Pairs ``key_a`` < ``key_b`` of rows whose texts look the same but are different strings."""
    scratch = Scratch(df.sparkSession, "alike")
    inside, group, string = _groups(df, key, text, scratch)
    # partial limits run before the shuffle, so a hot string sends at most COPIES rows per task
    copy = F.row_number().over(Window.partitionBy(string).orderBy("key"))
    kept = scratch.save(inside.withColumn("copy", copy).where(F.col("copy") <= COPIES), "kept")
    chunks = kept.groupBy(group).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    met = kept.join(chunks, group)
    a = met.select(*group, F.col("t").alias("ta"), F.col("key").alias("key_a"), F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk"))
    b = met.select(*group, F.col("t").alias("tb"), F.col("key").alias("key_b"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    full = a.join(b, [*group, "chunk"]).where("ta <> tb and key_a < key_b").select("key_a", "key_b")
    # copies beyond the limit meet the first row of another string
    rest = inside.join(kept.select(*string, "key"), [*string, "key"], "left_anti")
    first = kept.where("copy = 1").select(*group, F.struct("t", "key").alias("first"))
    anchors = first.groupBy(group).agg(F.min("first").alias("one"), F.max("first").alias("two"))
    other = F.when(F.col("t") == F.col("one.t"), F.col("two.key")).otherwise(F.col("one.key"))
    far = rest.join(anchors, group).select(F.least("key", other).alias("key_a"), F.greatest("key", other).alias("key_b"))
    return full.union(far)


def alike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, class_id, string_id, strings``: the rows whose look two or more strings share, with the smallest key of their look and of their string."""
    inside, group, string = _groups(df, key, text, Scratch(df.sparkSession, "alike"))
    each = inside.groupBy(string).agg(F.min("key").alias("string_id"))
    look = each.groupBy(group).agg(F.min("string_id").alias("class_id"), F.count("*").alias("strings"))
    return inside.join(each, string).join(look, group).select("key", "class_id", "string_id", "strings")
