import pytest

from parcelight.operators import orders
from parcelight.plans import dashboard, flows, retrieval, reviews
from parcelight.sources import schemas, sinks

HEADER = "Unnamed: 0,Clothing ID,Age,Title,Review Text,Rating,Recommended IND,Positive Feedback Count,Division Name,Department Name,Class Name\n"
ROWS = [
    '0,767,33,,"Soft and ""light"",\nlovely to wear",4,1,0,General,Tops,Knits\n',
    "1,767,33,,,4,1,0,General,Tops,Knits\n",
    "2,900,60,Nice,Too wide for me,2,0,3,General,Dresses,Dresses\n",
    "3,900,60,Nice,Too wide for me,2,0,3,General,Dresses,Dresses\n",
    "4,901,20,Hm,No class here,2,0,3,General,Dresses,\n",
]


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "reviews.csv"
    path.write_text(HEADER + "".join(ROWS))
    return str(path)


def test_reviews_from_csv_to_sql(spark, export):
    assert flows.store_reviews(spark, export, "reviews") == 2
    assert flows.store_reviews(spark, export, "reviews") == 2
    stored = {r["review_id"]: r for r in spark.table("reviews").collect()}
    assert set(stored) == {0, 2}
    assert (stored[0]["review_length"], stored[0]["age_bucket"], stored[0]["title"]) == (6, "25-34", None)
    comments = {r["col_name"]: r["comment"] for r in spark.sql("describe table reviews").collect()}
    assert comments["age_bucket"] == "Derived: age band"
    by_sql = spark.sql(
        "select department_name, round(avg(rating), 2) avg_rating, round(avg(recommended_ind) * 100, 1) rate,"
        " count(*) n from reviews group by department_name order by avg_rating desc"
    ).collect()
    by_frame = reviews.rating_by_department(spark.table("reviews")).collect()
    assert [tuple(r) for r in by_sql] == [tuple(r) for r in by_frame]


def test_mart_from_tables(spark, inputs):
    names = {
        "orders": "shop_orders", "items": "shop_items", "products": "shop_products",
        "sellers": "shop_sellers", "customers": "shop_customers", "reviews": "shop_reviews",
    }
    for name, view in names.items():
        sinks.replace_table(getattr(inputs, view), f"star_{name}")
    sources = {name: ["not_there", f"star_{name}"] for name in names}
    assert flows.store_order_mart(spark, sources, "mart") == 1473
    direct = orders.order_mart(**{name: getattr(inputs, view) for name, view in names.items()})
    key = lambda df: sorted(map(str, dashboard.late_rate_by_state(df).collect()))
    assert key(spark.table("mart")) == key(direct)
    with pytest.raises(KeyError):
        flows.store_order_mart(spark, {"orders": ["star_orders"]})
    with pytest.raises(FileNotFoundError):
        flows.store_order_mart(spark, {**sources, "items": ["not_there"]})


def test_index_grows_by_new_reviews_only(spark, export, tmp_path):
    found = flows.read_reviews(spark, export)
    table = reviews.clean_reviews(found)
    encoder = retrieval.fit_text_encoder(retrieval.chunk_reviews(table), dimensions=32)
    path = str(tmp_path / "index")
    assert flows.store_review_index(spark, table.where("review_id = 0"), path, encoder).count() == 1
    index = flows.store_review_index(spark, table, path, encoder)
    assert sorted(r["chunk_id"] for r in index.collect()) == ["0", "2"]


def test_star_schemas_have_the_columns_the_mart_needs(spark):
    frames = {
        "orders": schemas.ORDERS, "items": schemas.ORDER_ITEMS, "products": schemas.PRODUCTS,
        "sellers": schemas.SELLERS, "customers": schemas.CUSTOMERS, "reviews": schemas.ORDER_REVIEWS,
    }
    mart = orders.order_mart(**{n: spark.createDataFrame([], s) for n, s in frames.items()})
    assert mart.count() == 0 and "order_approved_at" in mart.columns
    paid = orders.payment_rollup(spark.createDataFrame([], schemas.ORDER_PAYMENTS))
    assert paid.columns == ["order_id", "payment_installments", "payment_type"]
