"""Declared schemas with column comments; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment} if comment else None)


# Header of the raw review export and the names used from then on.
REVIEW_HEADER = {
    "Clothing ID": "clothing_id",
    "Age": "age",
    "Title": "title",
    "Review Text": "review_text",
    "Rating": "rating",
    "Recommended IND": "recommended_ind",
    "Positive Feedback Count": "positive_feedback_count",
    "Division Name": "division_name",
    "Department Name": "department_name",
    "Class Name": "class_name",
}
ROW_NUMBER_HEADER = "Unnamed: 0"

REVIEWS = T.StructType(
    [
        _field("clothing_id", T.LongType(), "Item that was reviewed"),
        _field("age", T.IntegerType(), "Age of the reviewer after clipping"),
        _field("title", T.StringType(), "Headline, may be missing"),
        _field("review_text", T.StringType(), "Body of the review"),
        _field("rating", T.IntegerType(), "Stars, 1 to 5"),
        _field("recommended_ind", T.IntegerType(), "1 if the reviewer recommends it"),
        _field("positive_feedback_count", T.IntegerType(), "Votes from other readers"),
        _field("division_name", T.StringType(), "Product division"),
        _field("department_name", T.StringType(), "Product department"),
        _field("class_name", T.StringType(), "Product class"),
        _field("review_length", T.IntegerType(), "Derived: words in review_text"),
        _field("age_bucket", T.StringType(), "Derived: age band"),
    ]
)

_RAW_KINDS = {f.name: f.dataType for f in REVIEWS.fields}
RAW_REVIEWS = T.StructType(
    [T.StructField(ROW_NUMBER_HEADER, T.LongType())]
    + [T.StructField(raw, _RAW_KINDS[name]) for raw, name in REVIEW_HEADER.items()]
)

CUSTOMERS = T.StructType(
    [
        _field("customer_id", T.StringType()),
        _field("customer_unique_id", T.StringType()),
        _field("customer_zip_code_prefix", T.IntegerType()),
        _field("customer_city", T.StringType()),
        _field("customer_state", T.StringType()),
    ]
)
SELLERS = T.StructType(
    [
        _field("seller_id", T.StringType()),
        _field("seller_zip_code_prefix", T.IntegerType()),
        _field("seller_city", T.StringType()),
        _field("seller_state", T.StringType()),
    ]
)
PRODUCTS = T.StructType(
    [_field("product_id", T.StringType()), _field("product_category_name", T.StringType())]
    + [
        _field(f"product_{name}", T.IntegerType())
        for name in (
            "name_length",
            "description_length",
            "photos_qty",
            "weight_g",
            "length_cm",
            "height_cm",
            "width_cm",
        )
    ]
)
ORDERS = T.StructType(
    [
        _field("order_id", T.StringType()),
        _field("customer_id", T.StringType()),
        _field("order_status", T.StringType()),
        _field("order_purchase_timestamp", T.TimestampNTZType()),
        _field("order_approved_at", T.TimestampNTZType()),
        _field("order_delivered_customer_date", T.TimestampNTZType()),
        _field("order_estimated_delivery_date", T.TimestampNTZType()),
    ]
)
ORDER_ITEMS = T.StructType(
    [
        _field("order_id", T.StringType()),
        _field("order_item_id", T.IntegerType()),
        _field("product_id", T.StringType()),
        _field("seller_id", T.StringType()),
        _field("price", T.DoubleType()),
        _field("freight_value", T.DoubleType()),
    ]
)
ORDER_PAYMENTS = T.StructType(
    [
        _field("order_id", T.StringType()),
        _field("payment_sequential", T.IntegerType()),
        _field("payment_type", T.StringType()),
        _field("payment_installments", T.IntegerType()),
        _field("payment_value", T.DoubleType()),
    ]
)
ORDER_REVIEWS = T.StructType(
    [
        _field("review_id", T.StringType()),
        _field("order_id", T.StringType()),
        _field("review_score", T.IntegerType()),
        _field("review_comment_title", T.StringType()),
        _field("review_comment_message", T.StringType()),
        _field("review_creation_date", T.TimestampNTZType()),
        _field("review_answer_timestamp", T.TimestampNTZType()),
    ]
)


def ddl_type(kind: T.DataType) -> str:
    """Storage type name: whole numbers, fractions, everything else text."""
    if isinstance(kind, T.IntegralType):
        return "INTEGER"
    if isinstance(kind, T.FractionalType):
        return "FLOAT"
    return "VARCHAR"


def with_comments(schema: T.StructType, described: T.StructType = REVIEWS) -> T.StructType:
    """Copy the comments of ``described`` onto columns of the same name."""
    known = {f.name: f.metadata for f in described.fields}
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {**known.get(f.name, {}), **f.metadata})
            for f in schema.fields
        ]
    )


def create_table_text(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE`` text with one commented line per column."""
    lines = []
    for i, f in enumerate(schema.fields):
        comma = "," if i < len(schema.fields) - 1 else ""
        comment = f.metadata.get("comment", "")
        lines.append(f"    {f.name} {ddl_type(f.dataType)}{comma}" + (f"  -- {comment}" if comment else ""))
    return f"CREATE TABLE IF NOT EXISTS {table} (\n" + "\n".join(lines) + "\n);"
