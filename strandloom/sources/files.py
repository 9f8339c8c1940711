"""Scans of raw files, with the checks that a typed table needs.

A scan never infers a type: headed text files come as strings by column name,
and ``typed`` turns them into a declared table or raises with the first
offending value. Missing columns, ragged rows and empty files are errors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLUG = r"\A[a-z0-9]+(-[a-z0-9]+)*\z"


def _header(spark: SparkSession, path: str, separator: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    names = first[0].value.rstrip("\r").split(separator) if first else []
    if not names or names == [""]:
        raise ValueError(f"{path}: expected a header, received an empty file")
    return [n.strip('"') for n in names]


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A headed tab-separated file without quoting; carriage returns and blank lines vanish, a ragged row is an error."""
    names = _header(spark, path, "\t")
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line")).where(F.trim("line") != "")
    cells = F.split("line", "\t", -1)
    head = F.lit("\t".join(names))
    checked = F.when(F.size(cells) == len(names), cells).otherwise(F.raise_error(F.concat(F.lit(f"{path}: expected {len(names)} cells, received "), F.size(cells).cast("string"), F.lit(" in "), F.substring("line", 1, 120))))
    return lines.where(F.col("line") != head).select(checked.alias("c")).select(*(F.col("c")[k].alias(n) for k, n in enumerate(names)))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed comma-separated file with quoted cells, in which lines may break; a ragged row is an error."""
    names = _header(spark, path, ",")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST", enforceSchema=False)


def column(df: DataFrame, name: str, path: str = "table") -> Column:
    """A column by name, or an error that names the file."""
    if name not in df.columns:
        raise ValueError(f"{path}: expected a column {name!r}, received {df.columns}")
    return F.col(f"`{name}`")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, lines: bool = False) -> DataFrame:
    """JSON documents, or lines, compressed or not, of a declared shape; anything else is an error."""
    return spark.read.schema(schema).json(path, multiLine=not lines, mode="FAILFAST")


def in_order(scan: DataFrame) -> DataFrame:
    """A scan with ``ord``, which orders rows as they were written: by the time and name of their file, then by their place in it."""
    return scan.withColumn("ord", F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place")))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` of an append-only answer file or folder of files: the first answer of a key counts; a torn line is an error."""
    lines = in_order(spark.read.text(path)).select("value", "ord")
    cells = F.split("value", "\t", 2)
    checked = F.when(F.size(cells) == 2, cells).otherwise(F.raise_error(F.concat(F.lit(f"{path}: expected key and value, received "), F.substring("value", 1, 120))))
    rows = lines.where("value <> ''").select(checked.alias("c"), "ord").select(F.col("c")[0].alias("key"), F.col("c")[1].alias("value"), "ord")
    return rows.groupBy("key").agg(F.min(F.struct("ord", "value")).getField("value").alias("value"))


def read_property_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of JSON lines with a kind ``k``; ids are unique and every edge ends at a node."""
    schema = "k string, id string, text string, code string, type string, grades array<string>, rel string, `from` string, `to` string"
    rows = read_json(spark, path, schema, lines=True)
    nodes, edges = rows.where("k <> 'edge'").select("k", "id", "text", "code", "type", "grades"), rows.where("k = 'edge'").select("rel", F.col("from").alias("src"), F.col("to").alias("dst"))
    from strandloom.operators.relational import assert_none

    assert_none(nodes.groupBy("id").count().where("count > 1 or id is null"), f"{path}: a node's id is missing or used twice")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    assert_none(ends.join(nodes.select("id"), "id", "left_anti"), f"{path}: an edge ends at no node")
    return nodes, edges


def read_skos(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``node, label`` and ``node, broader`` of N-Triples, plain or compressed."""
    line = spark.read.text(path)
    label = r'^<([^>]+)>\s+<[^>]*[#/]prefLabel>\s+"((?:[^"\\]|\\.)*)"(?:@en)?\s*\.'
    broad = r"^<([^>]+)>\s+<[^>]*[#/]broader>\s+<([^>]+)>\s*\."
    cut = lambda p, names: line.where(F.col("value").rlike(p)).select(*(F.regexp_extract("value", p, k + 1).alias(n) for k, n in enumerate(names)))
    labels = cut(label, ["node", "label"]).withColumn("label", F.replace(F.replace("label", F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")))
    return labels, cut(broad, ["node", "broader"])


# Fixed value: categories of wikis that name no subject.
BAD_CATEGORY = r"(?i)^(Wikipedia|Lists of|List of|Categories |Redirects|Articles |Stubs|Templates|Commons|Set indices)"


def subject_labels(labels: DataFrame) -> DataFrame:
    """Labels that can name a subject: 2 to 50 characters, at most four words, no bracket or comma, no category of upkeep."""
    words = F.size(F.filter(F.split("label", r"\s+"), lambda w: w != ""))
    return labels.where(F.length("label").between(2, 50) & (words <= 4) & ~F.col("label").rlike(r"[(,]") & ~F.col("label").rlike(BAD_CATEGORY))


def tree_labels(labels: DataFrame) -> DataFrame:
    """Labels of a tree of headings: 2 to 80 characters, without a subdivision."""
    return labels.where(F.length("label").between(2, 80) & ~F.col("label").contains("--"))


def broadest(labels: DataFrame, broader: DataFrame, first: int = 25_000, most: int = 5_000) -> DataFrame:
    """``node, label, n``: the nodes that most others name as broader; of the ``first`` of them, the ``most`` first that have a label."""
    n = broader.groupBy(F.col("broader").alias("node")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "node").limit(first)
    named = labels.groupBy("node").agg(F.min("label").alias("label"))
    return named.join(n, "node").orderBy(F.desc("n"), "node").limit(most)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """``slug, ancestors`` with the nearest ancestor first."""
    rows = read_tsv(spark, path)
    return rows.select("slug", F.filter(F.split("ancestors", ","), lambda x: x != "").alias("ancestors"))


def read_vectors(spark: SparkSession, path: str, dim: int, key_bytes: int = 0) -> DataFrame:
    """``key, vec`` of a file of fixed-width records: ``key_bytes`` of key, then ``dim`` little-endian floats; a torn file is an error."""
    width = key_bytes + 4 * dim
    size = spark.read.format("binaryFile").load(path).select("length", "path")
    torn = size.where(F.col("length") % width != 0).limit(1).collect()
    if torn:
        raise ValueError(f"{torn[0].path}: expected records of {width} bytes, received {torn[0].length} bytes")
    records = spark.sparkContext.binaryRecords(path, width).map(lambda b: (bytearray(b),)).toDF("r binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_pylist()
            keys = pa.array([b[:key_bytes] for b in raw], pa.binary())
            x = np.frombuffer(b"".join(b[key_bytes:] for b in raw), "<f4")
            offsets = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, pa.array(x))], ["key", "vec"])

    return records.mapInArrow(cut, "key binary, vec array<float>")


# --- declared tables -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Cell:
    """A kind of cell: the pattern its text must have, and how it becomes a value."""

    pattern: str | None = None
    make: object = None
    low: int | None = None
    high: int | None = None
    longest: int | None = None

    def value(self, c: Column) -> Column:
        return self.make(c) if self.make else c

    def bad(self, c: Column) -> Column:
        out = c.isNull()
        if self.pattern:
            out = out | ~c.rlike(self.pattern)
        if self.longest:
            out = out | (F.length(c) > self.longest)
        if self.low is not None:
            n = c.try_cast("long")
            out = out | n.isNull() | ~n.between(self.low, self.high)
        return out


def whole(low: int, high: int) -> Cell:
    return Cell(r"\A-?\d+\z", lambda c: c.cast("int"), low, high)


_list = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
CELLS = {
    "slug": Cell(SLUG, longest=80), "text": Cell(), "filled": Cell(r"(?s).+"), "finite": Cell(r"\A-?\d+(\.\d+)?\z", lambda c: c.cast("double")), "bit": Cell(r"\A[01]\z", lambda c: c == "1"),
    "grade": Cell(r"\A(-?\d+)?\z", lambda c: F.when(c != "", c.cast("int"))), "slugs": Cell(r"\A([a-z0-9]+(-[a-z0-9]+)*(,[a-z0-9]+(-[a-z0-9]+)*)*)?\z", _list), "picks": Cell(r"\A(none|[a-z0-9]+(-[a-z0-9]+)*(,[a-z0-9]+(-[a-z0-9]+)*)*)\z", lambda c: F.when(c == "none", F.array().cast("array<string>")).otherwise(_list(c))),
    "match": Cell(r"\A[a-z0-9]+(-[a-z0-9]+)*\z", lambda c: F.when(c != "none", c)),
}


@dataclass(frozen=True)
class Table:
    """A declared table: its columns' kinds, its key, whether it may be empty."""

    name: str
    columns: dict[str, str | Cell]
    key: str | None = None
    empty: bool = False

    def cell(self, name: str) -> Cell:
        kind = self.columns[name]
        return kind if isinstance(kind, Cell) else CELLS[kind]


def typed(df: DataFrame, table: Table) -> DataFrame:
    """A frame of strings as the declared table; the first violation is an error. One pass finds them all."""
    if df.columns != list(table.columns):
        raise ValueError(f"{table.name}: expected the columns {list(table.columns)}, received {df.columns}")
    checks = [F.min(F.when(table.cell(c).bad(F.col(c)), F.coalesce(F.col(c), F.lit("null")))).alias(c) for c in table.columns]
    found = df.agg(F.count(F.lit(1)).alias("_n"), *checks).first()
    for c in table.columns:
        if found[c] is not None:
            raise ValueError(f"{table.name}: column {c} expected {table.columns[c]}, received {found[c]!r}")
    if not found["_n"] and not table.empty:
        raise ValueError(f"{table.name}: expected rows, received none")
    if table.key:
        twice = df.groupBy(table.key).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{table.name}: key {table.key} expected once, received {twice[0][0]!r} {twice[0][1]} times")
    return df.select(*(table.cell(c).value(F.col(c)).alias(c) for c in table.columns))


SKILL_LIST = Table("skill list", {"id": "slug", "title": "filled", "description": "text", "sources": "filled", "tags": "text"}, "id")
DIFFICULTY = Table("difficulty", {"id": "slug", "difficulty": whole(1, 20), "difficulty_raw": "finite", "anchored": "bit"}, "id")
SEEDS = Table("seed edges", {"src_id": "slug", "dst_id": "slug", "source": "filled", "confidence": "finite", "holdout": "bit", "fallback": "bit"}, empty=True)
EDGES = Table("edges", {"skill_id": "slug", "prereq_id": "slug"}, empty=True)
ALIASES = Table("aliases", {"dropped_id": "slug", "canonical_id": "slug"}, "dropped_id")
PICKS = Table("picks", {"skill": "slug", "picks": "picks"}, "skill")
SNAP = Table("snap", {"name": "slug", "match": "match"}, "name")
FINAL = Table("skills", {"id": "slug", "title": "filled", "display_title": "filled", "description": "text", "difficulty": whole(1, 20), "prereqs": "slugs", "occupations": "slugs", "topics": "slugs", "grade_start": "grade", "grade_end": "grade"}, "id")
