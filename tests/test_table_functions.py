from types import SimpleNamespace

import pytest

from starloom.registry.udfs import _reject_counts

from tests.conftest import rows


@pytest.mark.parametrize("kept", [3, 0])
def test_reject_counts_of_partitions_without_rows(spark, kept):
    made = [("p", None, "2020-01-01"), (None, "y", None), (None, None, "2020-01-02")][:kept]
    df = spark.createDataFrame(made, "PATIENT string, PAYER string, STOP string").repartition(8)
    counts = dict(rows(_reject_counts(SimpleNamespace(spark=spark), df)))
    assert counts == ({"no patient": 2, "no payer": 2, "still open": 1} if kept else
                      {"no patient": 0, "no payer": 0, "still open": 0})
