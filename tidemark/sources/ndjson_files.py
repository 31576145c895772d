"""Strict newline-delimited JSON over numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.contract import MAX_REASONS, REASON_TYPE
from tidemark.functions.values import cap_reasons, last_wins

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# What a text trim removes.
_SPACE = "\\s\\u000B\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF"


def is_json(text: Column) -> Column:
    """The text is exactly one JSON value.

    Spark's parser stops after the first value, so the text is parsed inside an array, which rejects
    a second member, and inside an object before a mark only this text has, which rejects an early end.
    """
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT)
    mark = F.xxhash64(text)
    framed = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit(',"end":'), mark.cast("string"), F.lit("}")), "v string, end bigint", STRICT)
    return F.coalesce((F.size(alone) == 1) & (framed["end"] == mark), F.lit(False))


def check_lines(lines: DataFrame) -> DataFrame:
    """Per line: `problem` (a reason code) or, for an object, its `keys`."""
    text = F.col("text")
    blank = text.rlike(f"^[{_SPACE}]*\\z")
    problem = (
        F.when(blank, F.lit("empty_line"))
        .when(~is_json(text), F.lit("invalid_json"))
        .when(~text.rlike(r"^[ \t]*\{"), F.lit("not_an_object"))
    )
    checked = lines.withColumn("problem", problem)
    return checked.withColumn("keys", F.when(F.col("problem").isNull(), F.array_distinct(F.json_object_keys("text"))))


# Fixed values.
MESSAGES = {"empty_line": "empty line", "invalid_json": "line is not valid JSON", "not_an_object": "line is not a JSON object"}


def key_sets(checked: DataFrame) -> DataFrame:
    """The distinct key lists of each file; headers are resolved once per list, not per line."""
    return checked.filter("keys IS NOT NULL").select("file", F.col("keys").alias("headers")).distinct()


def line_reasons(checked: DataFrame, resolved: DataFrame) -> DataFrame:
    """(file, line_no, position, reason) of every problem, in file order."""
    bad = checked.filter("problem IS NOT NULL")
    message = F.lit(None).cast("string")
    for code, text in MESSAGES.items():
        message = F.when(F.col("problem") == code, F.lit(text)).otherwise(message)
    own = bad.select("file", "line_no", F.lit(0).alias("position"), F.struct(
        F.col("problem").alias("code"), message.alias("message"), F.col("line_no").cast("int").alias("line")).alias("reason"))
    unresolved = resolved.filter(F.size("reasons") > 0).select("file", F.col("headers").alias("keys"), "reasons")
    keyed = checked.filter("keys IS NOT NULL").select("file", "line_no", "keys").join(unresolved, ["file", "keys"])
    each = keyed.select("file", "line_no", F.posexplode("reasons").alias("position", "r"))
    header = each.select("file", "line_no", "position", F.struct(
        "r.code", "r.message", F.col("line_no").cast("int").alias("line")).alias("reason"))
    return own.unionByName(header)


def file_reasons(reasons: DataFrame) -> DataFrame:
    """(file, reasons): the first 20 in line order and how many more, however many lines are broken."""
    order = Window.partitionBy("file").orderBy("line_no", "position")
    first = reasons.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= MAX_REASONS)
    listed = first.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("_n", "reason"))).alias("l"))
    total = reasons.groupBy("file").agg(F.count(F.lit(1)).alias("total"))
    texts = F.transform(F.col("l"), lambda x: x["reason"].cast(REASON_TYPE))
    return listed.join(total, "file").select("file", cap_reasons(texts, F.col("total")).alias("reasons"))


def file_columns(resolved: DataFrame) -> DataFrame:
    """(file, columns): the union of the header maps of a file's key lists."""
    pairs = resolved.filter(F.size("reasons") == 0).select("file", F.explode("columns").alias("header", "column")).distinct()
    return pairs.groupBy("file").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("header", "column")))).alias("columns"))


def payloads(checked: DataFrame) -> DataFrame:
    """(file, line_no, payload): numbers and booleans as text, nested values as JSON text, last duplicate wins."""
    objects = checked.filter("keys IS NOT NULL")
    plain = F.from_json("text", "map<string,string>", STRICT)
    # Numbers with a point or an exponent have several spellings; they are read as values and written in one.
    read = F.transform_values(F.from_json("text", "map<string,variant>", STRICT), lambda _, v: _value_text(v))
    payload = F.when(F.col("text").rlike("[0-9][.eE]"), last_wins(read)).otherwise(last_wins(plain))
    return objects.select("file", "line_no", payload.alias("payload"))


def _value_text(value: Column) -> Column:
    """A JSON value as text; a number in its shortest form (1.0 -> 1, 1e3 -> 1000, 1e-7 -> 1e-7)."""
    number = F.try_variant_get(value, "$", "double")
    short = F.regexp_replace(F.regexp_replace(number.cast("string"), r"(\.0)?E", "e"), "e([0-9])", "e+$1")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e21)
    text = F.when(whole, number.try_cast("decimal(38,0)").cast("string")).otherwise(short)
    return F.when(F.schema_of_variant(value) == "DOUBLE", text).otherwise(F.try_variant_get(value, "$", "string"))
