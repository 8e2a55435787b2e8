"""What training reads is computed once."""

from pyspark.sql import functions as F

from parcelight.registry import modeling as registry
from parcelight.sources.fixtures import Inputs


def test_stages_read_stored_rows(spark, monkeypatch):
    numbers = {c: (F.col("id") * 37 % (11 + n)).cast("double") for n, c in enumerate(registry._NUMERIC)}
    left = spark.range(300).withColumns(numbers).withColumn("payment_type", F.when(F.col("id") % 5 > 0, "card"))
    right = spark.range(300).withColumn("product_category", F.concat(F.lit("Brand#"), (10 + F.col("id") % 50).cast("string")))
    frame = left.join(right.hint("merge"), "id").withColumnRenamed("id", "order_id")
    monkeypatch.setattr(registry, "unfilled", lambda i: frame)
    for run in (registry._preprocessed, registry._one_hot):
        made = run(Inputs(spark, "none"))
        assert made.count() == 300
        assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
