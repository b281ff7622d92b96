from types import SimpleNamespace

import pytest

from starloom.config import fresh_dir, shared_dir


def session(master, **conf):
    """What ``shared_dir`` asks of a session; a cluster's own would be a server."""
    values = {k.replace("_", "."): v for k, v in conf.items()}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, *d: values.get(k, *d)))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,4,1024]", "local[8]"])
@pytest.mark.parametrize("path", ["/mnt/shared", "file:/mnt/shared/", "file:///mnt/shared", "s3a://bucket/shared"])
def test_checkpoint_folder_is_taken_as_given(master, path):
    spark = session(master, spark_checkpoint_dir=path, **{"spark_sql_warehouse_dir": "/mnt/warehouse"})
    assert shared_dir(spark) == path.rstrip("/")
    assert fresh_dir(spark, "x").startswith(path.rstrip("/") + "/x-")


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,4,1024]"])
def test_a_cluster_without_one_uses_the_warehouse(master):
    spark = session(master, spark_sql_warehouse_dir="file:/mnt/warehouse/")
    assert shared_dir(spark) == "file:/mnt/warehouse/starloom-work"
