"""Event records of the two topics: schemas and decoding."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

ORDER_EVENT = (
    "event_id string, event_type string, timestamp string, order_id bigint,"
    " customer_id string, customer_name string, customer_country string, customer_city string,"
    " employee_id int, employee_name string, shipper_id int, shipper_name string,"
    " order_date string, required_date string, freight decimal(18,2),"
    " order_items array<struct<product_id: bigint, product_name: string, unit_price: decimal(18,2),"
    " quantity: int, discount: decimal(5,3), line_total: decimal(18,2)>>,"
    " order_total decimal(18,2), grand_total decimal(18,2), item_count int, units_ordered int,"
    " payment_method string, payment_status string, confirmation_code string,"
    " shipped_date string, tracking_number string, shipper string,"
    " delivered_date string, delivery_status string, signature_required boolean,"
    " cancellation_reason string, refund_status string"
)

USER_EVENT = (
    "event_id string, user_id bigint, event_type string, timestamp string, page string,"
    " session_id string,"
    " metadata struct<browser: string, device: string, ip_address: string>,"
    " purchase_data struct<product_id: bigint, amount: decimal(18,2), currency: string>,"
    " search_query string"
)

CORRUPT = "_corrupt"


def decode(records: DataFrame, schema: str) -> DataFrame:
    """Topic records (key, value) as typed events.

    A value that is not a JSON record of the schema keeps its text in ``_corrupt``. The record
    goes through ``inline``, past which no filter is pushed: every text is parsed once.
    """
    columns = f"{schema}, {CORRUPT} string"
    text = F.col("value").cast("string")
    event = F.from_json(text, columns, {"columnNameOfCorruptRecord": CORRUPT})
    blank = text.isNull() | (F.trim(text) == "")
    return (
        records.select(
            F.col("key").cast("string").alias("key"),
            F.when(blank, F.coalesce(text, F.lit(""))).alias("_blank"),
            F.inline(F.array(event)),
        )
        .withColumn(CORRUPT, F.coalesce(CORRUPT, "_blank"))
        .drop("_blank")
    )


def readable(events: DataFrame) -> DataFrame:
    return events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(events: DataFrame) -> DataFrame:
    """Records that could not be read, with their text."""
    return events.filter(F.col(CORRUPT).isNotNull()).select("key", F.col(CORRUPT).alias("value"))
