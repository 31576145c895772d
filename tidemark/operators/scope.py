"""Reading and writing inside one tenant's scope. Scoping within a trusted job, not access control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def scope(df: DataFrame, tenant_id: str | None) -> DataFrame:
    """Only the tenant's rows; no tenant gives no rows. A blank tenant id is an error."""
    if tenant_id is None:
        return df.filter(F.lit(False))
    if tenant_id.strip() == "":
        raise ValueError("a scope needs a non-empty tenant id")
    return df.filter(F.col("tenant_id") == tenant_id)


def checked_for(df: DataFrame, tenant_id: str) -> DataFrame:
    """The same rows, failing the job on the first row of another tenant; put before a scoped write."""
    if tenant_id.strip() == "":
        raise ValueError("a scope needs a non-empty tenant id")
    message = F.concat(F.lit("row of another tenant: "), F.coalesce("tenant_id", F.lit("none")))
    own = F.when(F.col("tenant_id") == tenant_id, F.col("tenant_id")).otherwise(F.raise_error(message).cast("string"))
    return df.withColumn("tenant_id", own)


def scoped_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temporary views that show only the tenant named by the session variable `current_tenant`.

    While the variable is NULL every view is empty. Set it with SET VARIABLE current_tenant = '...'.
    """
    spark.sql("DECLARE OR REPLACE VARIABLE current_tenant STRING DEFAULT NULL")
    for name, df in tables.items():
        df.createOrReplaceTempView(f"all_{name}")
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM all_{name} "
            "WHERE tenant_id = system.session.current_tenant")
