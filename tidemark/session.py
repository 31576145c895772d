"""Session settings the engine relies on, and where intermediate tables are cut."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values are text ("01" must not become 1).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on; sizes and core counts stay the cluster's."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Intermediate tables go nowhere else."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named.rstrip("/")


def listed(problems: DataFrame, shown: int = 100) -> list[str]:
    """The column `text` of problem rows in order of the columns: the first ones, and how many more there are.

    All of them are in the table that the last line names."""
    table = cut(problems, "problems")
    total = table.count()
    lines = [r.text for r in table.orderBy(*table.columns).limit(shown).collect()]
    return lines + ([f"and {total - shown} more, all in {table.inputFiles()[0].rsplit('/', 1)[0]}"] if total > shown else [])


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage so that a frame with several readers is computed once, is read column by column, and
    survives the loss of the executors that wrote it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark/{uuid.uuid4().hex}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cut independent frames with their jobs running side by side, so one's last tasks do not idle the cluster."""
    shared_folder(next(iter(frames.values())).sparkSession)
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        running = {name: pool.submit(cut, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in running.items()}


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Control rows as a local relation, whose exact size Catalyst knows (a parallelized list has none)."""
    struct = T._parse_datatype_string(schema)
    names = struct.fieldNames()
    columns = [[row[i] for row in rows] for i in range(len(names))]
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=struct)


_shipped: set[str] = set()
#: Bytes of an Arrow batch. A task holds one several times, off the heap of its JVM and in its Python worker.
BATCH_BYTES = 2 << 20
#: Rows that Spark's Parquet reader holds of a column at once (4,096 by default: with long texts tens of MB of heap a task).
READ_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's executors, once for each application."""
    # Texts are long: a batch of Spark's default number of rows can hold gigabytes.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark.conf.get("spark.sql.parquet.columnarReaderBatchSize", None) is None:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    held = Path(tempfile.mkdtemp()) / "tidemark-package.zip"  # Spark serves it to the executors from here
    with zipfile.ZipFile(held, "w") as z:
        for path in sorted((root / "tidemark").rglob("*.py")):
            z.write(path, path.relative_to(root))
    sc.addPyFile(str(held))
    _shipped.add(sc.applicationId)
