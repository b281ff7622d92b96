"""Writers. A table never has files replaced under a reader: new content goes to a new
folder and the table's location is switched, increments are appended. ``partitions`` does the
same for single partitions."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from starloom.schemas import RAW_FILES


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _writer(df: DataFrame, fmt: str):
    return df.write.format(fmt)


def create_or_replace(
    df: DataFrame,
    name: str,
    base_path: str,
    fmt: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Full content of an external table, first load or replacement.

    The content is complete on storage before the catalog points to it, so a job that dies
    halfway leaves the table as it was. The plan may read the very table it replaces.
    """
    spark = df.sparkSession
    path = f"{base_path.rstrip('/')}/v_{uuid.uuid4().hex}"
    known = table_exists(spark, name)
    buckets = _buckets(spark, name) if known else bucket_by
    if buckets:
        count, column = buckets
        # the files are written through a table of its own, whose entry then goes again
        first = f"{name}_{uuid.uuid4().hex[:8]}" if known else name
        writer = _writer(df, fmt).option("path", path).bucketBy(count, column).sortBy(column)
        writer.saveAsTable(first)
        if not known:
            return
        spark.sql(f"DROP TABLE {first}")
    else:
        _writer(df, fmt).mode("errorifexists").save(path)
    if known:
        before = _location(spark, name)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
        _forget_older(spark, base_path, {before, path})
    else:
        spark.catalog.createTable(name, path=path, source=fmt)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def _buckets(spark: SparkSession, name: str) -> tuple[int, str] | None:
    """Number of buckets and bucket column the catalog holds for a table."""
    known = _described(spark, name)
    count = int(known.get("Num Buckets", 0) or 0)
    return (count, known["Bucket Columns"].strip("[]`").replace("`", "")) if count else None


def _forget_older(spark: SparkSession, base_path: str, keep: set[str]) -> None:
    """Delete versions of a table but the current one and the one before, which a reader that
    planned before the switch may still scan."""
    base, files = _files(spark, base_path)
    names = {path.rstrip("/").rsplit("/", 1)[-1] for path in keep}
    for status in files.listStatus(base):
        version = status.getPath().getName()
        if version.startswith("v_") and version not in names:
            files.delete(status.getPath(), True)


def append(df: DataFrame, name: str) -> None:
    """Append rows; the files of earlier loads stay as they are."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name)
    spark.catalog.refreshTable(name)


#: rows of a file of an extract; a compressed file is one task's work
EXTRACT_ROWS = 250_000


def write_extract(df: DataFrame, folder: str, entity: str) -> None:
    """One headered CSV extract, compressed, in files of bounded size."""
    writer = df.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", EXTRACT_ROWS)
    writer.csv(f"{folder.rstrip('/')}/{RAW_FILES[entity]}")


def build_once(df: DataFrame, name: str, base_path: str, fmt: str = "parquet") -> bool:
    """Write the table unless it exists; True when it was written."""
    if table_exists(df.sparkSession, name):
        return False
    create_or_replace(df, name, base_path, fmt)
    return True


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written itself."""
    folder, files = _files(spark, path)
    files.delete(folder, True)


def write_jdbc(df: DataFrame, url: str, table: str, partitions: int = 8, **options) -> None:
    """Append to a database table over at most ``partitions`` connections.

    User and password come from the environment (``JDBC_USER``, ``JDBC_PASSWORD``).
    """
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    writer = writer.option("numPartitions", partitions)
    for variable, option in [("JDBC_USER", "user"), ("JDBC_PASSWORD", "password")]:
        if os.environ.get(variable):
            writer = writer.option(option, os.environ[variable])
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()
