"""Batch files as physical lines, numbered across the splits Spark reads them in."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import cut, ship, small_frame
from tidemark.sources.paths import plain, plain_encoded

PIECE_BYTES = 8 << 20
MISSING = "missing"
BOM = "﻿"


def list_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Files below `paths` with their size; contents are not read.

    A scan leaves out files without any bytes, so the names come from the scan's own file index.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    sizes = files.select(plain(F.col("path")).alias("file"), F.col("length").alias("bytes"))
    names = small_frame(spark, [(name,) for name in files.inputFiles()], "uri string")
    return names.select(plain_encoded(F.col("uri")).alias("file")).join(sizes, "file", "left").select(
        "file", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def _open(path: str):
    """A stream of a file on the cluster's file systems."""
    if "://" in path and not path.startswith("file:"):
        system, name = FileSystem.from_uri(path)
        return system.open_input_stream(name)
    return open(path.removeprefix("file:"), "rb")


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for file in batch.column(0).to_pylist():
            digest, size, error = hashlib.sha256(), 0, None
            try:
                with _open(file) as stream:
                    while piece := stream.read(PIECE_BYTES):
                        digest.update(piece)
                        size += len(piece)
            except (FileNotFoundError, IsADirectoryError, NotADirectoryError):
                error = MISSING
            except (OSError, pa.ArrowException) as problem:
                error = f"{type(problem).__name__}: {problem}"
            rows.append({"file": file, "bytes": size, "sha256": digest.hexdigest() if error is None else None, "error": error})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("error", pa.string())]))


def hash_files(files: DataFrame) -> DataFrame:
    """(file, bytes, sha256, error) of each named file: lower-case hex, read as a stream whatever its size.

    A file that cannot be read has an error (MISSING if there is none) and takes no other file with it.
    """
    ship(files.sparkSession)
    # A number of partitions of its own, which AQE does not merge: names are few bytes, what they name is not.
    parts = 4 * files.sparkSession.sparkContext.defaultParallelism
    names = files.select("file").repartition(parts, "file").distinct()
    return names.mapInArrow(_hash, "file string, bytes bigint, sha256 string, error string")


def plain_path(uri: str) -> str:
    """A folder's path as file names are given: without the `file:` scheme."""
    return re.sub("^file:/+", "/", uri)


def escaped(path: str) -> str:
    """A path whose characters with a meaning in file patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, pos, text): every physical line; within a block `pos` counts up line by line.

    Large files are split over tasks. The result is written once, because the split boundaries of a
    second scan need not be the same.
    """
    text = spark.read.option("lineSep", "\n").text([escaped(p) for p in paths])
    lines = text.select(
        plain_encoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("text"), F.col("_metadata.file_size").alias("size"))
    return cut(lines, "lines")


def lines_of(texts: DataFrame, file: str, text: str) -> DataFrame:
    """The same relation for whole texts held in a column."""
    each = texts.select(F.col(file).alias("file"), F.posexplode(F.split(text, "\n")).alias("pos", "text"))
    size = F.lit(-1).cast("bigint")  # the piece after the last line end is a line here, so no text ends in one
    return each.select("file", F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("pos"), "text", size.alias("size"))


@dataclass(frozen=True)
class Numbered:
    lines: DataFrame  # file, block, line_no, text, open_at_start, quotes
    files: DataFrame  # file, utf8, last_line, quotes


def quotes_in(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def number_lines(lines: DataFrame) -> Numbered:
    """Physical line numbers, and whether each line starts inside a quoted field.

    Counts are summed per block first; running sums over a file then see one row per block. Only lines
    of blocks that contain quotes are ordered, and only within their block.
    """
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.sum(quotes_in(F.col("text"))).alias("block_quotes"),
        F.max(F.when(~F.col("text").isin("", "\r"), F.col("pos"))).alias("last_pos"), F.min(F.is_valid_utf8("text")).alias("utf8"),
        F.sum(F.octet_length("text") + 1).alias("bytes"), F.max("size").alias("size"),
        F.min_by(F.col("text").isin(BOM, BOM + "\r"), "pos").alias("marked"), F.max_by(F.col("text") == "\r", "pos").alias("bare"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    last = F.col("lines_before") + F.col("last_pos") - F.col("first_pos") + 1
    # Only line ends are dropped from the end of a file: a carriage return without one is a line. A byte-order mark
    # is no content at the start of a file, and a line of its own anywhere else.
    # Readers leave out a mark of three bytes at the start.
    size = F.first("size").over(whole)
    unended = (size < 0) | (F.sum("bytes").over(whole) - size).isin(1, -2)
    bare = F.max_by("bare", "block").over(whole) & unended
    found = F.coalesce(F.max(last).over(whole), F.lit(0))
    found = F.when((found == 1) & F.min_by("marked", "block").over(whole), 0).otherwise(found)
    blocks = (
        blocks.withColumn("lines_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("quotes_before", F.coalesce(F.sum("block_quotes").over(earlier), F.lit(0)))
        .withColumn("last_line", F.when(bare, F.sum("n").over(whole)).otherwise(found))
        .select("file", "block", "first_pos", "lines_before", "quotes_before", "block_quotes", "last_line", "utf8")
    )
    blocks = cut(blocks, "blocks")  # one row per block, read for the lines and for the files
    files = blocks.groupBy("file").agg(
        F.min("utf8").alias("utf8"), F.max("last_line").alias("last_line"), F.sum("block_quotes").alias("quotes"))
    at = lines.join(blocks, ["file", "block"])
    at = at.withColumn("line_no", F.col("lines_before") + F.col("pos") - F.col("first_pos") + 1)
    at = at.filter("line_no <= last_line").withColumn("quotes", quotes_in(F.col("text")))
    in_block = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    even = at.filter("block_quotes = 0").withColumn("_before", F.col("quotes_before"))
    odd = at.filter("block_quotes > 0").withColumn(
        "_before", F.col("quotes_before") + F.coalesce(F.sum("quotes").over(in_block), F.lit(0)))
    text = F.regexp_replace("text", r"\r\z", "")
    text = F.when(F.col("line_no") == 1, F.regexp_replace(text, "^" + BOM, "")).otherwise(text)
    numbered = even.unionByName(odd).select(
        "file", "block", "line_no", text.alias("text"), (F.col("_before") % 2 == 1).alias("open_at_start"), "quotes")
    return Numbered(numbered, files)
