"""Layer layout, job configuration and Spark session."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


@dataclass(frozen=True)
class Layer:
    """One storage layer: where its files live and which database lists its tables."""

    path: str
    database: str


@dataclass(frozen=True)
class LakeConfig:
    raw_path: str
    enriched: Layer
    curated: Layer
    table_format: str = "parquet"
    app_name: str = "starloom"
    spark_conf: dict = field(default_factory=dict)
    packages: tuple = ()


def load_config(path: str) -> LakeConfig:
    """Read a YAML job file with ``paths``, ``metastore`` and ``spark`` sections.

    Object-store credentials are taken from the environment by the Hadoop provider
    chain and never from this file.
    """
    import yaml

    with open(path, encoding="utf-8") as handle:
        doc = yaml.safe_load(handle)
    spark_section = doc.get("spark") or {}
    conf = {str(k): str(v) for k, v in (spark_section.get("config") or {}).items()}
    conf = {k: v for k, v in conf.items() if not k.endswith(("access.key", "secret.key"))}
    return LakeConfig(
        raw_path=doc["paths"]["raw"],
        enriched=Layer(doc["paths"]["enriched"], doc["metastore"]["enriched"]),
        curated=Layer(doc["paths"]["curated"], doc["metastore"]["curated"]),
        table_format=doc.get("format", "parquet"),
        app_name=(doc.get("application") or {}).get("name", "starloom"),
        spark_conf=conf,
        packages=tuple(spark_section.get("packages") or ()),
    )


def database_name(target: str, custom: str | None = None) -> str:
    """A model's own database where it names one, else the target's."""
    return custom.strip() if custom and custom.strip() else target


def build_session(config: LakeConfig | None = None, master: str | None = None) -> SparkSession:
    """Session with UTC clock and adaptive execution; cluster settings win over defaults."""
    builder = SparkSession.builder.appName(config.app_name if config else "starloom")
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if config:
        conf.update(config.spark_conf)
        if config.packages:
            conf["spark.jars.packages"] = ",".join(config.packages)
    return builder.config(map=conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors all reach.

    ``spark.checkpoint.dir``, if given, whatever its scheme: a path without one, or with
    ``file:``, is a mount as often as one machine's disk. Else a folder of the warehouse, which
    a cluster shares as well; only a session that is one process takes a temporary folder.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not is_one_process(context.master):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/starloom-work"
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-"))
    return context.getCheckpointDir()


def is_one_process(master: str) -> bool:
    """Whether the executor is the driver itself; ``local-cluster`` starts processes of its own."""
    return master == "local" or master.startswith("local[")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
