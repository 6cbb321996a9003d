"""Sources and sinks: raw CSV with a fixed schema, Parquet, catalog tables and views.

Writes are full replacements (overwrite), the analogue of a warehouse load with
truncate. Locations are parameters: on a cluster they name shared storage.

``load`` is the raw load for files that may be damaged: rows that do not fit the schema go to a quarantine table,
and the new version of the table takes the place of the old one in one step.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_EVENTS, RAW_USERS

_BAD = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema=None, sampling: float = 1.0) -> DataFrame:
    """CSV with a header; an explicit schema avoids the extra inference pass. A cell that does not fit
    its type raises an error instead of turning NULL. ``sampling`` is the share of rows used to infer types."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True).option("samplingRatio", sampling)
    return reader.csv(path)


def read_users_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_USERS)


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_EVENTS)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times keep their microseconds (the default format cuts them to milliseconds)."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_sorted_events(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """Event log written in (user_id, event_ts) order: range partitions sorted locally,
    so the files concatenate in order without a single-task global sort."""
    n = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (events.repartitionByRange(n, "user_id", "event_ts")
     .sortWithinPartitions("user_id", "event_ts")
     .write.mode("overwrite").parquet(path))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def save_table(df: DataFrame, table: str, bucket_by: tuple[int, str] | None = None,
               partition_by: list[str] | None = None) -> None:
    """Materialise as a Parquet catalog table (full replace). Bucketing by user_id lets
    later joins on user_id read both sides without an exchange."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(table)


def load_csv_to_table(spark: SparkSession, path: str, table: str, schema=None, sampling: float = 1.0) -> DataFrame:
    """Raw load: CSV (given schema, or one inferred from a share ``sampling`` of the rows) into a table, replacing it."""
    df = read_csv(spark, path, schema, sampling)
    save_table(df, table)
    return spark.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A lazily evaluated view (staging models are views)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


@dataclass
class Load:
    """What a load brought: the table's name, its rows, the rows held back and the table that holds them."""

    table: str
    rows: int
    rejected: int
    quarantine: str


def read_csv_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line of a CSV as a row of ``schema`` plus ``_corrupt_record``: the raw line where a cell does not fit its type or
    the number of cells is wrong, else NULL."""
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).schema(with_bad).csv(path)


def publish(spark: SparkSession, df: DataFrame, table: str) -> str:
    """Replace ``table`` in one step: write a new version beside it, then point the name (a view) at it. Readers see the old rows or the
    new ones, never neither, and a failed write leaves the old ones. Returns the version's name."""
    version = f"{table}__{uuid.uuid4().hex}"
    save_table(df, version)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    return version


def load(spark: SparkSession, path: str, table: str, schema: T.StructType, most_rejected: float = 0.1) -> Load:
    """CSV into ``table``, replacing it; lines that do not fit ``schema`` go to ``<table>_rejected`` as they are. The file is
    parsed once (both parts are read from the parsed copy), and the two parts add up to its lines.

    More than a share ``most_rejected`` of bad lines raises an error and leaves the table as it was."""
    parsed = f"{table}__parsed_{uuid.uuid4().hex}"
    save_table(read_csv_rows(spark, path, schema), parsed)
    both = spark.table(parsed)
    total, bad = both.agg(F.count(F.lit(1)), F.count(_BAD)).first()
    if bad > most_rejected * total:
        raise ValueError(f"{bad} of {total} lines of {path} do not fit the schema of {table}")
    quarantine = f"{table}_rejected"
    publish(spark, both.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line")), quarantine)
    publish(spark, both.where(F.col(_BAD).isNull()).drop(_BAD), table)
    spark.sql(f"DROP TABLE {parsed}")
    return Load(table, total - bad, bad, quarantine)


def lineage(spark: SparkSession, database: str) -> DataFrame:
    """name, kind, definition: every table and view of a database, with the query of a view as the catalogue holds it."""
    rows = []
    for t in spark.catalog.listTables(database):
        if not t.isTemporary:
            found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{t.name}").collect()}
            rows.append((t.name, "view" if t.tableType == "VIEW" else "table", found.get("View Text")))
    return spark.createDataFrame(rows, "name string, kind string, definition string")
