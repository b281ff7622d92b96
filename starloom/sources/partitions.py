"""Partitioned tables whose partitions are replaced by switching where they lie.

A replacement writes the new content of the partitions it touches to a folder of its own and
then tells the catalog the new place of each. No file goes under a reader: the place before the
switch stays until the partition is replaced once more. A job that dies while it writes leaves
the table as it was; the list of switches is on storage before the first of them, so one that
dies between two switches is completed by the next writer (``recover``). One writer per table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.sources.sinks import _files, remove_folder, table_exists

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: partitions added by one statement
ADDED_AT_ONCE = 200

Spec = tuple[tuple[str, str], ...]


def create(df: DataFrame, name: str, base_path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """First content of a table partitioned by columns without nulls."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    types = dict(df.dtypes)
    path = _written(df.select(*columns), base_path, partition_by, fmt)
    listed = ", ".join(f"`{c}` {types[c]}" for c in columns)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    found = _partitions(spark, path, len(partition_by))
    spark.sql(f"CREATE TABLE {name} ({listed}) USING {fmt} PARTITIONED BY ({parts}) LOCATION '{base_path}'")
    _switch(spark, name, found, set())


def replace(df: DataFrame, name: str, base_path: str, touched: Sequence[dict] = (), fmt: str = "parquet") -> None:
    """Put ``df`` in place of the partitions it has rows of, and of those in ``touched``: one of
    those without rows goes. Others are not read. The plan may read the table it replaces."""
    spark = df.sparkSession
    recover(spark, name, base_path)
    partition_by = partition_columns(spark, name)
    known = set(_known(spark, name))
    path = _written(df.select(*spark.table(name).columns), base_path, partition_by, fmt)
    places: dict[Spec, str | None] = {_spec(t, partition_by): None for t in touched}
    places |= _partitions(spark, path, len(partition_by))
    before = _places(spark, name, [s for s in places if s in known])
    journal = f"{base_path.rstrip('/')}/_switch_{uuid.uuid4().hex}"
    rows = [(repr(spec), place) for spec, place in places.items()] or [(None, None)]
    spark.createDataFrame(rows, "spec string, place string").coalesce(1).write.json(journal)
    _switch(spark, name, places, known)
    remove_folder(spark, journal)
    _forget(spark, base_path, places, before)


def replace_groups(df: DataFrame, name: str, base_path: str, group: str, fmt: str = "parquet") -> None:
    """Replace the stored rows of the groups that occur in ``df``; other groups stay. Only the
    partitions ``df`` has rows of are read and written anew."""
    spark = df.sparkSession
    recover(spark, name, base_path)
    partition_by = partition_columns(spark, name)
    staged = f"{base_path.rstrip('/')}/_staged_{uuid.uuid4().hex}"
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    touched = [r.asDict() for r in rows.select(*partition_by).distinct().collect()]  # at most the partitions
    stored = within(spark.table(name), touched)
    groups = rows.select(F.col(group).alias("_group")).distinct()
    kept = stored.join(groups, F.col(group) == F.col("_group"), "leftanti")
    replace(rows.unionByName(kept), name, base_path, touched, fmt)
    remove_folder(spark, staged)


def within(df: DataFrame, touched: Sequence[dict]) -> DataFrame:
    """The rows of the given partitions; a filter on literals, so that others are not scanned."""
    if not touched:
        return df.limit(0)
    columns = list(touched[0])
    if len(columns) == 1:
        return df.where(F.col(columns[0]).isin([t[columns[0]] for t in touched]))
    one: list[Column] = [reduce(and_, (F.col(c) == t[c] for c in columns)) for t in touched]
    return df.where(reduce(or_, one))


def recover(spark: SparkSession, name: str, base_path: str) -> int:
    """Complete the switches of a writer that died among them; how many lists there were. A list
    that is not complete itself is of a writer that had not begun to switch."""
    base, files = _files(spark, base_path)
    if not files.exists(base):
        return 0
    done = 0
    for status in files.listStatus(base):
        path = status.getPath()
        if not path.getName().startswith("_switch_"):
            continue
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            rows = spark.read.schema("spec string, place string").json(path.toString()).where("spec is not null").collect()
            _switch(spark, name, {_read_spec(r["spec"]): r["place"] for r in rows}, set(_known(spark, name)))
            done += 1
        files.delete(path, True)
    return done


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


# --- places ------------------------------------------------------------------------------

def _spec(values: dict, partition_by: Sequence[str]) -> Spec:
    return tuple((c, str(values[c])) for c in partition_by)


def _read_spec(text: str) -> Spec:
    import ast

    return ast.literal_eval(text)


def _sql(spec: Spec) -> str:
    values = (f"`{c}`='" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for c, v in spec)
    return f"PARTITION ({', '.join(values)})"


def _written(df: DataFrame, base_path: str, partition_by: Sequence[str], fmt: str) -> str:
    # names sort by time, so that the newest versions of a partition are known
    path = f"{base_path.rstrip('/')}/w_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt).partitionBy(*partition_by)
    if fmt == "parquet":  # digits of digests take half the room; what is replaced stays for a while
        writer = writer.option("compression", "zstd")
    writer.save(path)
    return path


def _partitions(spark: SparkSession, path: str, depth: int) -> dict[Spec, str]:
    """The partitions a writer has left below a folder, and where."""
    root, files = _files(spark, path)
    level = [((), root)]
    for _ in range(depth):
        below = []
        for spec, folder in level:
            for status in files.listStatus(folder):
                column, _, value = status.getPath().getName().partition("=")
                if status.isDirectory() and value:
                    below.append((spec + ((unquote(column), unquote(value)),), status.getPath()))
        level = below
    if empty := [s for s, _ in level if any(v == _NO_VALUE for _, v in s)]:
        raise ValueError(f"partition columns must not be null: {empty}")
    return {spec: folder.toString() for spec, folder in level}


def _known(spark: SparkSession, name: str) -> list[Spec]:
    shown = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [tuple(tuple(map(unquote, p.split("=", 1))) for p in r["partition"].split("/")) for r in shown]


def _places(spark: SparkSession, name: str, specs: Sequence[Spec]) -> dict[Spec, str]:
    """Where the files of partitions lie, from one listing of just those."""
    if not specs:
        return {}
    held = within(spark.table(name), [dict(s) for s in specs])
    folders = {unquote(f).rsplit("/", 1)[0] for f in held.inputFiles()}
    tails = {_inside(s): s for s in specs}
    return {tails[t]: f for f in folders if (t := _tail(f).partition("/")[2]) in tails}


def _inside(spec: Spec) -> str:
    """A partition's folder below that of a write, as the writer names it."""
    return "/".join(f"{_escaped(c)}={_escaped(v)}" for c, v in spec)


def _escaped(text: str) -> str:
    odd = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in odd else c for c in text)


def _switch(spark: SparkSession, name: str, places: dict[Spec, str | None], known: set[Spec]) -> None:
    """Tell the catalog; new partitions in few statements."""
    added = [f"{_sql(s)} LOCATION '{p}'" for s, p in places.items() if p and s not in known]
    for lo in range(0, len(added), ADDED_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[lo : lo + ADDED_AT_ONCE])}")
    for spec, place in places.items():
        if spec not in known:
            continue
        if place:
            spark.sql(f"ALTER TABLE {name} {_sql(spec)} SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_sql(spec)}")
    if table_exists(spark, name):
        spark.catalog.refreshTable(name)


def _forget(spark: SparkSession, base_path: str, places: dict[Spec, str | None], before: dict[Spec, str]) -> None:
    """Delete what lies of the replaced partitions, but for the place now and the one before."""
    base, files = _files(spark, base_path)
    writes = [s.getPath() for s in files.listStatus(base) if s.getPath().getName().startswith("w_")]
    part = spark._jvm.org.apache.hadoop.fs.Path
    for spec, now in places.items():
        keep = {_tail(p) for p in (now, before.get(spec)) if p}
        for write in writes:
            if f"{write.getName()}/{_inside(spec)}" not in keep:
                files.delete(part(write, _inside(spec)), True)


def _tail(place: str) -> str:
    """The write's folder and the partition's below it."""
    at = place.rfind("/w_")
    return place[at + 1 :].rstrip("/") if at >= 0 else place
