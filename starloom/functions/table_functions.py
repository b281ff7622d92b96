"""Table functions over encounters: one row, or one partition, to many rows.

Each keeps a bounded number of values between rows, so a partition may be of any size.
"""

from __future__ import annotations

import datetime
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import arrow_udtf, udtf

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@udtf(returnType="charge_day string, charge_cents bigint")
class DailyCharges:
    """Spreads the cost of an encounter evenly over the days it touches. Cents that do not
    divide go to the first days; an open or reversed span is charged on its first day."""

    def eval(self, start: str, stop: str, cents: int):
        if start is None or cents is None:
            return
        first = datetime.date.fromisoformat(start)
        span = (datetime.date.fromisoformat(stop) - first).days if stop else 0
        days = max(span, 0) + 1
        each, left_over = divmod(cents, days)
        for n in range(days):
            yield (first + datetime.timedelta(days=n)).isoformat(), each + (n < left_over)


@udtf(returnType="reason string, rejected bigint")
class RejectCounts:
    """TABLE argument: per partition, how many encounters miss what a fact row needs.

    A partition without rows gives none: Spark joins what a function yields to the row it read
    last, and fails where it read none."""

    RULES = {
        "no patient": lambda row: row["PATIENT"] is None,
        "no payer": lambda row: row["PAYER"] is None,
        "still open": lambda row: row["STOP"] is None,
    }

    def __init__(self):
        self.counts = {}

    def eval(self, row: Row):
        for reason, broken in self.RULES.items():
            self.counts[reason] = self.counts.get(reason, 0) + broken(row)

    def terminate(self):
        yield from self.counts.items()


@udtf(returnType="patient string, gap_from string, gap_days int")
class CareGaps:
    """TABLE argument, partitioned by patient and ordered by start: stretches without care
    of at least ``least_days`` days between the end of all earlier encounters and the next."""

    def __init__(self):
        self.until = None

    def eval(self, row: Row, least_days: int):
        start, stop = row["START"].date(), (row["STOP"] or row["START"]).date()
        if self.until is not None and (start - self.until).days >= least_days:
            yield row["PATIENT"], self.until.isoformat(), (start - self.until).days
        self.until = stop if self.until is None else max(self.until, stop)


@arrow_udtf(returnType="account string, entries bigint, balance double, floor_hits bigint, ceiling_hits bigint")
class BoundedBalance:
    """TABLE argument over Arrow columns, partitioned by account and ordered by time: a balance
    that every amount moves but that stays between two bounds. What a bound cuts off is lost, so
    the end depends on the order, and no sum over a window gives it."""

    def __init__(self):
        self.account, self.entries, self.balance, self.hits = None, 0, 0.0, [0, 0]

    def eval(self, batch: pa.RecordBatch, floor: pa.Array, ceiling: pa.Array):
        low, high = floor[0].as_py(), ceiling[0].as_py()
        self.account = batch.column("account")[0].as_py()
        for amount in batch.column("amount").drop_null().to_pylist():
            moved = self.balance + amount
            self.hits[0] += moved < low
            self.hits[1] += moved > high
            self.balance, self.entries = min(max(moved, low), high), self.entries + 1
        return iter(())

    def terminate(self):
        values = [self.account, self.entries, self.balance, *self.hits]
        names = ["account", "entries", "balance", "floor_hits", "ceiling_hits"]
        kinds = [pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds)})


FUNCTIONS = {
    "daily_charges": DailyCharges,
    "reject_counts": RejectCounts,
    "care_gaps": CareGaps,
    "bounded_balance": BoundedBalance,
}


def register_all(spark: SparkSession) -> None:
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
