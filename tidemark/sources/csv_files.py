"""Strict CSV over numbered lines: shape checks, records at the line they start on, fields as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.values import reason

# What may stand between two quotes of a field: anything, with quotes doubled. Possessive, so that long
# fields are matched in a loop.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = f'"{_INNER}"'


def check_lines(lines: DataFrame) -> DataFrame:
    """Per line: `delimiters` outside quotes, `open_at_end`, and `stray` for a quote out of place.

    A line is judged with nothing but whether it starts inside a quoted field, so no record has to be
    put together first.
    """
    text = F.col("text")
    closes = text.rlike(f'^{_INNER}"')
    rest = F.when(F.col("open_at_start"), F.when(closes, F.regexp_replace(text, f'^{_INNER}"', "")).otherwise(F.lit(""))).otherwise(text)
    bad_close = F.col("open_at_start") & closes & (rest != "") & ~F.startswith(rest, F.lit(","))
    bare = F.regexp_replace(rest, f"(^|,){_FIELD}(?=,|\\z)", "$1")
    bare = F.regexp_replace(bare, f'(^|,)"{_INNER}\\z', "$1")
    plain = ~F.col("open_at_start") & (F.col("quotes") == 0)
    outside = F.when(plain, text).otherwise(bare)
    return (
        lines.withColumn("_outside", outside)
        .withColumn("stray", F.when(plain, F.lit(False)).otherwise(bad_close | F.contains(F.col("_outside"), F.lit('"'))))
        .withColumn("delimiters", F.length("_outside") - F.length(F.replace("_outside", F.lit(","), F.lit(""))))
        .withColumn("open_at_end", F.col("open_at_start") != (F.col("quotes") % 2 == 1))
        .drop("_outside")
    )


def _multi_line(checked: DataFrame) -> DataFrame:
    """Lines of records that span lines, with the line their record starts on.

    A segmented scan: each block's last record start is carried to the blocks after it, one row per block, and
    lines are put in order inside their block only. A file of nothing but such lines spreads over all its blocks.
    """
    lines = checked.filter("open_at_start OR open_at_end").withColumn(
        "_start", F.when(~F.col("open_at_start"), F.col("line_no")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lines.groupBy("file", "block").agg(F.max("_start").alias("_last")).select(
        "file", "block", F.max("_last").over(earlier).alias("_carried"))
    so_far = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    # Line numbers go up, so the greatest start so far is the last one.
    return lines.join(carried, ["file", "block"]).withColumn(
        "record", F.coalesce(F.max("_start").over(so_far), "_carried")).drop("_start", "_carried")


def record_shapes(checked: DataFrame) -> DataFrame:
    """(file, record, end_line, fields, stray): each record by its start line, without its text."""
    single = checked.filter("NOT open_at_start AND NOT open_at_end").select(
        "file", F.col("line_no").alias("record"), F.col("line_no").alias("end_line"),
        (F.col("delimiters") + 1).alias("fields"), "stray")
    multi = _multi_line(checked).groupBy("file", "record").agg(
        F.max("line_no").alias("end_line"), (F.sum("delimiters") + 1).alias("fields"),
        (F.max("stray") | F.max_by("open_at_end", "line_no")).alias("stray"))
    return single.unionByName(multi.withColumn("fields", F.col("fields").cast("int")))


def shape_reasons(shapes: DataFrame) -> DataFrame:
    """(file, reason): the first record with a quote out of place or another number of fields than the header."""
    header = shapes.filter("record = 1").select("file", F.col("fields").alias("expected"))
    judged = shapes.join(header, "file").filter(F.col("stray") | (F.col("fields") != F.col("expected")))
    first = judged.groupBy("file").agg(F.min(F.struct(
        "record", (~F.col("stray")).alias("whole"), "end_line", "fields", "expected")).alias("f"))
    at = F.col("f.end_line")
    count = reason("column_count", F.format_string(
        "Invalid Record Length: expect %s, got %s on line %s",
        F.col("f.expected").cast("string"), F.col("f.fields").cast("string"), at.cast("string")), at)
    stray = reason("malformed_csv", F.format_string(
        "a quote is out of place in the record on line %s", F.col("f.record").cast("string")))
    return first.select("file", F.when(F.col("f.whole"), count).otherwise(stray).alias("reason"))


def record_texts(checked: DataFrame) -> DataFrame:
    """(file, line_no, text, quoted): each record's text at the line it starts on."""
    single = checked.filter("NOT open_at_start AND NOT open_at_end").select(
        "file", "line_no", "text", (F.col("quotes") > 0).alias("quoted"))
    multi = _multi_line(checked).groupBy("file", F.col("record").alias("line_no")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("line_no").alias("n"), "text"))).alias("l"))
    multi = multi.select(
        "file", "line_no", F.array_join(F.col("l.text"), "\n").alias("text"), F.lit(True).alias("quoted"))
    return single.unionByName(multi)


def fields(text: Column, quoted: Column) -> Column:
    """The fields of a well-formed record as an array of texts."""
    split = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(f',({_FIELD}|[^,"]*)'), F.lit(1))
    unquoted = F.transform(split, lambda f: F.when(
        F.startswith(f, F.lit('"')), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(quoted, unquoted).otherwise(F.split(text, ","))


def headers(records: DataFrame) -> DataFrame:
    """(file, headers) from each file's first record."""
    return records.filter("line_no = 1").select("file", fields(F.col("text"), F.col("quoted")).alias("headers"))


def payloads(records: DataFrame, headers_: DataFrame) -> DataFrame:
    """(file, line_no, payload) of the data records of well-formed files."""
    data = records.filter("line_no > 1").join(headers_, "file")
    return data.select(
        "file", "line_no", F.map_from_arrays("headers", fields(F.col("text"), F.col("quoted"))).alias("payload"))
