"""The engine's tables as Parquet folders: control tables, append-only ledger, raw layer and publications."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.contract import APPEND_ONLY, PARTITIONS, TABLES
from tidemark.session import configure


class Store:
    """Tables below one folder. History tables can only be appended to."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = configure(spark)
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def read(self, table: str) -> DataFrame:
        schema = TABLES[table]
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, table: str, df: DataFrame, mode: str) -> None:
        names = [f.name for f in self.spark.createDataFrame([], TABLES[table]).schema]
        if PARTITIONS[table]:  # else every task would write a file into every folder
            df = df.hint("rebalance", *PARTITIONS[table])
        writer = df.select(*names).write.mode(mode)
        if PARTITIONS[table]:
            writer = writer.partitionBy(*PARTITIONS[table])
        writer.parquet(self.path(table))

    def append(self, table: str, df: DataFrame) -> None:
        self._write(table, df, "append")

    def replace(self, table: str, df: DataFrame) -> None:
        """Replace a control table (partition by partition where it has any)."""
        if table in APPEND_ONLY:
            raise ValueError(f"{table} is append-only")
        self._write(table, df, "overwrite")

    def replace_all(self, table: str, df: DataFrame) -> None:
        """Replace a whole control table, partitions that have no row any more included."""
        if table in APPEND_ONLY:
            raise ValueError(f"{table} is append-only")
        names = [f.name for f in self.spark.createDataFrame([], TABLES[table]).schema]
        writer = df.select(*names).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*PARTITIONS[table]).parquet(self.path(table))

    def committed(self, table: str) -> DataFrame:
        """Rows of a publication table whose run has been recorded; a crashed run stays invisible."""
        return self.read(table).join(self.read("run").select("tenant_id", "run_id"), ["tenant_id", "run_id"], "left_semi")

    def max_id(self, table: str, column: str) -> int:
        return self.read(table).agg(F.max(column)).first()[0] or 0

    def claim(self, above: int) -> int:
        """A number larger than `above` and the clock that no job has had, not even one that died.

        Claims stay as folders, which can only be created once."""
        number = max(int(time.time()), above + 1)
        while True:
            try:
                self.spark.range(1).write.mode("errorifexists").parquet(f"{self.base}/claims/{number}")
                return number
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                number += 1
