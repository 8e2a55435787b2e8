import pytest
from pyspark.sql import functions as F

from parcelight.operators.history import seller_hist_late_rate
from parcelight.operators.orders import PURCHASED
from parcelight.streaming.seller_history import SellerHistory, follow_orders


@pytest.fixture(scope="module")
def shop(spark, inputs):
    first = inputs.shop_orders.agg(F.min(PURCHASED)).first()[0]
    day = F.datediff(PURCHASED, F.lit(first))
    orders = inputs.shop_orders.where(day < 500).withColumn(
        "part", F.when(F.col("order_id") % 7 == 0, 2).when(day < 250, 0).otherwise(1)
    )
    return orders.checkpoint(), inputs.shop_items.checkpoint()


def _as_rows(df):
    return {r["order_id"]: round(r["seller_hist_late_rate"], 12) for r in df.collect()}


def test_arriving_batches_give_the_batch_result(spark, shop, tmp_path):
    orders, items = shop
    lines = lambda batch: items.join(batch.select("order_id"), "order_id", "left_semi")
    history = SellerHistory(spark, str(tmp_path / "h"), unit="week")
    for number in (0, 1, 2):  # the last one is late: its orders lie among those of the others
        batch = orders.where(F.col("part") == number).drop("part")
        history.add(number, batch, lines(batch))
        so_far = orders.where(F.col("part") <= number).drop("part")
        assert _as_rows(history.rates()) == _as_rows(seller_hist_late_rate(so_far, items))
    # the same batch again, and its orders under another number, count nothing twice
    want = _as_rows(history.rates())
    batch = orders.where("part = 1").drop("part")
    history.add(1, batch, lines(batch))
    history.add(3, batch, lines(batch))
    assert _as_rows(history.rates()) == want


def test_empty_batch_changes_nothing(spark, shop, tmp_path):
    orders, items = shop
    history = SellerHistory(spark, str(tmp_path / "h"), unit="week")
    few = orders.where("part = 0").drop("part")
    history.add(0, few, items)
    want = _as_rows(history.rates())
    history.add(1, few.limit(0), items)
    assert _as_rows(history.rates()) == want


def test_stream_of_files_survives_a_failure(spark, shop, tmp_path):
    orders, items = shop
    schema = orders.drop("part").schema
    for number in range(3):
        orders.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    history = SellerHistory(spark, str(tmp_path / "h"))
    arrivals = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    broken = {"left": 1}

    def lines(batch):
        if broken["left"]:
            broken["left"] -= 1
            raise RuntimeError("lost")
        return items.join(batch.select("order_id"), "order_id", "left_semi")

    progress = str(tmp_path / "p")
    with pytest.raises(Exception, match="lost"):
        follow_orders(arrivals(), lines, history, progress).awaitTermination()
    follow_orders(arrivals(), lines, history, progress).awaitTermination()
    follow_orders(arrivals(), lines, history, progress).awaitTermination()
    assert _as_rows(history.rates()) == _as_rows(seller_hist_late_rate(orders.drop("part"), items))
