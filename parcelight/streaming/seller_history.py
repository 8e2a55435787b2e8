"""Seller lateness kept up to date as orders arrive, without redoing all history.

Three tables below one folder: ``pairs`` (each delivered order once per seller,
by arrival and day), ``totals`` (pairs and late pairs of a seller on a day, by
arrival) and ``rates`` (the result, by day).  A batch touches its earliest day and
those after it; what lies before is known from the totals alone.  A day's orders
that come in time so cost one day; orders that come late cost the days since.

Every batch writes under its own number, which a repeated batch overwrites, so a
restart counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelight.operators.history import seller_order_pairs
from parcelight.operators.orders import PURCHASED
from parcelight.operators.prefix import in_blocks, prior_totals, prior_totals_in_blocks
from parcelight.session import cut_lineage

_TIME = [PURCHASED, "order_id"]


class SellerHistory:
    """Seller history in a folder that all executors share; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str, min_history: int = 3, unit: str = "day"):
        """``unit`` is the length of a day in the folder: ``day``, ``week`` or ``month``."""
        self.spark, self.folder, self.min_history, self.unit = spark, folder, min_history, unit

    def _stored(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{table}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def rates(self) -> DataFrame:
        """order_id and seller_hist_late_rate of every delivered order that arrived."""
        return self.spark.read.parquet(f"{self.folder}/rates").select("order_id", "seller_hist_late_rate")

    def add(self, batch: int, orders: DataFrame, items: DataFrame) -> None:
        """Take in a batch of orders with their lines and renew the days from its earliest one on.

        An order that arrived in an earlier batch keeps what it said then.  The
        same batch may be added again; it replaces itself.  A batch without a
        delivered order changes nothing.
        """
        pairs = seller_order_pairs(orders, items).withColumn("day", F.to_date(F.date_trunc(self.unit, PURCHASED)))
        known = self._stored("pairs")
        if known is not None:
            days = pairs.agg(F.min("day"), F.max("day")).first()
            same_days = known.where((F.col("batch") != batch) & F.col("day").between(*[F.lit(d) for d in days]))
            pairs = pairs.join(same_days.select("order_id"), "order_id", "left_anti")
        fresh = cut_lineage(pairs)
        first_day = self._replace(batch, fresh, known)
        if first_day is not None:
            self._renew(first_day)

    def _replace(self, batch: int, fresh: DataFrame, known: DataFrame | None):
        """Write the batch's pairs and totals; the earliest day that this or its earlier attempt touched."""
        earlier = None
        if known is not None:
            earlier = known.where(F.col("batch") == batch).agg(F.min("day")).first()[0]
        now = fresh.agg(F.min("day")).first()[0]
        days = [d for d in (earlier, now) if d is not None]
        if not days:
            return None
        totals = fresh.groupBy("seller_id", "day").agg(F.count(F.lit(1)).alias("orders"), F.sum("late").alias("late"))
        fresh.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{self.folder}/pairs/batch={batch}")
        totals.write.mode("overwrite").parquet(f"{self.folder}/totals/batch={batch}")
        return min(days)

    def _renew(self, first_day) -> None:
        """Rates of the days from ``first_day`` on, from their pairs and the totals of earlier days."""
        pairs = self._stored("pairs").where(F.col("day") >= F.lit(first_day))
        totals = self._stored("totals").where(F.col("day") < F.lit(first_day))
        before = cut_lineage(totals.groupBy("seller_id").agg(F.sum("orders").alias("__orders"), F.sum("late").alias("__late")))
        all_before = before.agg(F.coalesce(F.sum("__orders"), F.lit(0)).alias("n"), F.coalesce(F.sum("__late"), F.lit(0)).alias("late")).first()
        columns = ["order_id", "seller_id", PURCHASED, "late", "day"]
        blocked = in_blocks(pairs.select(*columns), _TIME, ["seller_id"])
        one = F.lit(1).cast("bigint")
        sold = prior_totals_in_blocks(blocked, _TIME, {"__since": one, "__since_late": F.col("late")}, partition_by=["seller_id"])
        per_order = blocked.groupBy("order_id", PURCHASED).agg(F.count(F.lit(1)).alias("__n"), F.sum("late").alias("__l"))
        everyone = prior_totals(per_order, _TIME, {"__all": F.col("__n"), "__all_late": F.col("__l")})
        orders = F.coalesce("__orders", F.lit(0)) + F.col("__since")
        late = F.coalesce("__late", F.lit(0)) + F.col("__since_late")
        all_pairs, all_late = F.col("__all") + F.lit(all_before["n"]), F.col("__all_late") + F.lit(all_before["late"])
        own = F.when(orders >= self.min_history, late / orders)
        overall = F.when(all_pairs >= self.min_history, all_late / all_pairs)
        rated = (
            sold.join(before, "seller_id", "left")
            .join(everyone.select("order_id", "__all", "__all_late"), "order_id")
            .groupBy("order_id", "day")
            .agg(F.avg(F.coalesce(own, overall, F.lit(0.0))).alias("seller_hist_late_rate"))
        )
        (
            rated.hint("rebalance", "day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(f"{self.folder}/rates")
        )


def follow_orders(
    orders: DataFrame, items_of: Callable[[DataFrame], DataFrame], history: SellerHistory, progress: str
) -> StreamingQuery:
    """Feed a stream of orders to a history and stop when all that is there is done.

    ``items_of`` gives the lines of a batch of orders.  ``progress`` records the
    batches; the one that a failure interrupts is repeated under its number.
    """

    def add(batch: DataFrame, number: int) -> None:
        stored = cut_lineage(batch)
        history.add(number, stored, items_of(stored))

    return (
        orders.writeStream.foreachBatch(add).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
