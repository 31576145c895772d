"""Tenant configuration files -> control relations, and the rules they must follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contract import CLOSED_VALUES, CURRENCY, SOURCE_COLUMNS, SOURCES, TENANT_ID
from tidemark.functions.values import last_wins
from tidemark.session import cut, listed, small_frame
from tidemark.sources.paths import base_name

SOURCE_TYPE = "struct<columnAliases:map<string,array<string>>,valueMaps:map<string,map<string,string>>>"
CONFIG_TYPE = (
    f"struct<id:string,displayName:string,currency:string,fixturesDir:string,sources:map<string,{SOURCE_TYPE}>>")
TOP_KEYS = ["id", "displayName", "currency", "fixturesDir", "sources"]
SOURCE_KEYS = ["columnAliases", "valueMaps"]


@dataclass(frozen=True)
class Control:
    """What the configuration says, as relations."""

    tenant: DataFrame  # tenant_id, display_name, currency, fixtures_dir
    configured: DataFrame  # tenant_id, source
    alias: DataFrame  # tenant_id, source, canonical, alias
    value_map: DataFrame  # tenant_id, source, column_name, raw_value, canonical_value


def scan_tenants(spark: SparkSession, directory: str) -> DataFrame:
    """Each *.json file of the directory with its name, parsed config and raw text."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(directory).select(
        F.regexp_replace(base_name(F.col("_metadata.file_name")), r"\.json$", "").alias("file_id"),
        F.regexp_replace("value", "^﻿", "").alias("text"))
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    parsed = files.withColumn("config", F.from_json("text", CONFIG_TYPE, options)).withColumn(
        "keys", F.json_object_keys("text"))
    return cut(parsed, "tenants")


def control_of(scanned: DataFrame) -> Control:
    base = scanned.select(F.col("file_id").alias("tenant_id"), "config.*")
    source = base.select("tenant_id", F.explode(last_wins(F.col("sources"))).alias("source", "s")).filter("s IS NOT NULL")
    alias = source.select("tenant_id", "source", F.posexplode(F.map_entries(last_wins(F.col("s.columnAliases")))).alias("cpos", "e"))
    maps = source.select("tenant_id", "source", F.explode(last_wins(F.col("s.valueMaps"))).alias("column_name", "m"))
    return Control(
        tenant=base.select(
            "tenant_id", F.col("displayName").alias("display_name"), "currency", F.col("fixturesDir").alias("fixtures_dir")),
        configured=source.select("tenant_id", "source"),
        alias=alias.select(
            "tenant_id", "source", F.col("e.key").alias("canonical"), "cpos", F.posexplode("e.value").alias("apos", "alias")),
        value_map=maps.select("tenant_id", "source", "column_name", F.explode(last_wins(F.col("m"))).alias("raw_value", "canonical_value")),
    )


def _canonical(spark: SparkSession) -> DataFrame:
    rows = [(s, c) for s, columns in SOURCE_COLUMNS.items() for c in columns]
    return small_frame(spark, rows, "source string, column_name string")


def alias_problems(alias: DataFrame) -> DataFrame:
    """Aliases that would make a header ambiguous, one row each."""
    canonical = _canonical(alias.sparkSession)
    own = canonical.select("source", F.col("column_name").alias("alias"), F.lit(True).alias("is_column"))
    owners = alias.groupBy("tenant_id", "source", "alias").agg(
        F.min(F.struct("cpos", "apos", "canonical")).alias("first"))
    a = alias.join(own, ["source", "alias"], "left").join(owners, ["tenant_id", "source", "alias"])
    later = F.struct("cpos", "apos", "canonical") != F.col("first")
    message = (
        F.when(F.col("alias") == F.col("canonical"), F.format_string(
            'alias "%s" repeats the canonical name, which is always accepted', "alias"))
        .when(F.col("is_column"), F.format_string(
            'alias "%s" for "%s" is itself a column of %s, so that header would be ambiguous', "alias", "canonical", "source"))
        .when(later & (F.col("first.canonical") == F.col("canonical")), F.format_string(
            'alias "%s" is listed twice for "%s"', "alias", "canonical"))
        .when(later, F.format_string(
            'alias "%s" is mapped to both "%s" and "%s"; a header must map to one column', "alias", "first.canonical", "canonical"))
    )
    where = F.concat(F.lit("sources."), "source", F.lit(".columnAliases."), "canonical")
    return a.select("tenant_id", where.alias("path"), message.alias("message")).filter("message IS NOT NULL")


def closed_target_problems(value_map: DataFrame) -> DataFrame:
    """Value map targets of a closed column that are not one of its values."""
    spark = value_map.sparkSession
    closed = small_frame(
        spark, [(s, c, ", ".join(v)) for (s, c), v in CLOSED_VALUES.items()], "source string, column_name string, allowed string")
    values = small_frame(
        spark, [(s, c, v) for (s, c), vs in CLOSED_VALUES.items() for v in vs],
        "source string, column_name string, canonical_value string")
    bad = value_map.join(closed, ["source", "column_name"]).join(
        values, ["source", "column_name", "canonical_value"], "left_anti")
    where = F.concat_ws(".", F.lit("sources"), "source", F.lit("valueMaps"), "column_name", "raw_value")
    return bad.select("tenant_id", where.alias("path"), F.format_string(
        'value map target "%s" for %s.%s is not one of %s', "canonical_value", "source", "column_name", "allowed").alias("message"))


def config_problems(scanned: DataFrame) -> DataFrame:
    """(tenant_id, code, path, message) for every rule a tenant file breaks.

    A file that is not JSON has only that problem; one whose id is not its name is judged on that last.
    """
    base = scanned.select("file_id", "text", "keys", "config", F.col("config.*")).withColumnRenamed("file_id", "tenant_id")
    readable = base.filter("keys IS NOT NULL AND config IS NOT NULL")

    missing = lambda c: F.coalesce(F.length(c), F.lit(0)) == 0
    control = control_of(scanned)
    known = _canonical(scanned.sparkSession)
    unknown_column = (
        control.alias.select("tenant_id", "source", F.col("canonical").alias("column_name"))
        .unionByName(control.value_map.select("tenant_id", "source", "column_name")).distinct()
        .join(known, ["source", "column_name"], "left_anti")
        .select("tenant_id", F.concat(F.lit("sources."), "source").alias("path"),
                F.format_string('"%s" is not a column of %s', "column_name", "source").alias("message")))
    rules = [
        (~F.coalesce(F.col("id").rlike(TENANT_ID), F.lit(False)), "id", "lowercase letters, digits and underscores"),
        (missing("displayName"), "displayName", "must not be empty"),
        (~F.coalesce(F.col("currency").rlike(CURRENCY), F.lit(False)), "currency", "ISO 4217 code"),
        (missing("fixturesDir"), "fixturesDir", "must not be empty"),
        (F.col("fixturesDir").rlike(r"^([/\\]|[A-Za-z]:)"), "fixturesDir", "must be a relative path"),
        (F.array_contains(F.split("fixturesDir", r"[/\\]"), ".."), "fixturesDir", 'must not contain ".." segments'),
        (F.size(F.array_except("keys", F.array(*map(F.lit, TOP_KEYS)))) > 0, "(root)", "unrecognized key"),
        (F.size(F.array_except(F.map_keys("sources"), F.array(*map(F.lit, SOURCES)))) > 0, "sources", "unrecognized key"),
        (F.coalesce(F.size(F.filter(F.map_values("sources"), lambda s: s.isNotNull())), F.lit(0)) <= 0,
         "sources", "at least one source is required"),
    ]
    broken_rules = F.array(*[
        F.when(bad, F.struct(F.lit(path).alias("path"), F.lit(text).alias("message"))) for bad, path, text in rules])
    invalid = readable.select("tenant_id", F.explode(broken_rules).alias("r")).filter("r IS NOT NULL").select("tenant_id", "r.*")
    for more in (alias_problems(control.alias), closed_target_problems(control.value_map), unknown_column):
        invalid = invalid.unionByName(more)
    invalid = invalid.withColumn("code", F.lit("invalid_config"))
    broken = base.filter("keys IS NULL OR config IS NULL").select(
        "tenant_id", F.lit("").alias("path"), F.lit("not a JSON object").alias("message"), F.lit("invalid_json").alias("code"))
    mismatch = readable.filter("id <> tenant_id").join(invalid.select("tenant_id"), "tenant_id", "left_anti").select(
        "tenant_id", F.lit("").alias("path"),
        F.format_string('declares id "%s"; the file name must match the id', "id").alias("message"),
        F.lit("id_mismatch").alias("code"))
    return broken.unionByName(invalid).unionByName(mismatch)


def read_tenants(spark: SparkSession, directory: str) -> Control:
    """Every tenant file of the directory; any broken rule refuses them all."""
    scanned = scan_tenants(spark, directory)
    problems = listed(config_problems(scanned).select(
        "tenant_id", "path", F.concat(F.col("tenant_id"), F.lit(".json "), F.col("path"), F.lit(": "), F.col("message")).alias("text")))
    if problems:
        raise ValueError("Invalid tenant config:\n" + "\n".join(problems))
    return control_of(scanned)
