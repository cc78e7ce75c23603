"""The retail model over the warehouse files.

Every table is a projection of one file, plus at most a join with a fixed lookup, so reading
the model never shuffles. Money is decimal from the start: sums are exact and independent of
the order in which partitions are merged.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.sources import fixed_values, readers, schemas


def _quoted(values) -> str:
    return ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)


def pick(values, index: Column) -> Column:
    """The fixed value at a position counted from 0, null beyond the list."""
    return F.get(F.expr(f"array({_quoted(values)})"), index.cast("int"))


def _lookup(pairs, key: Column) -> Column:
    """The fixed value of a key, null for other keys."""
    return F.expr(f"map({_quoted(v for pair in pairs for v in pair)})")[key]


def _cents(column: str, precision: int = 12) -> Column:
    """A price in cents, as decimal dollars."""
    return F.col(column).cast(f"decimal({precision},2)") * F.lit("0.01").cast("decimal(3,2)")


class RetailTables:
    """The source catalog: ``tables.orders``, ``tables.table("raw", "user_events")`` and so on."""

    def __init__(self, spark: SparkSession, folder: str, format: str = "parquet"):
        self.spark = spark
        self.folder = folder
        self.format = format

    def file(self, name: str) -> DataFrame:
        return readers.raw_zone(
            self.spark, f"{self.folder}/{name}.{self.format}", schemas.FILES[name], self.format
        )

    # Trading tables

    @property
    def orders(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        key = F.col("o_orderkey")
        area = F.col("o_custkey") % 25
        return self.file("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (key % 9 + 1).cast("int").alias("employee_id"),
            day.alias("order_date"),
            F.date_add(day, 7).alias("required_date"),
            F.when(
                F.col("o_orderstatus") != "O", F.date_add(day, (key % 13).cast("int"))
            ).alias("shipped_date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("ship_via"),
            (
                F.col("o_totalprice").cast("decimal(12,2)")
                * F.lit("0.0004").cast("decimal(5,4)")
            ).alias("freight"),
            F.concat(F.lit("Dock "), (key % 100).cast("string")).alias("ship_name"),
            F.concat((key % 500).cast("string"), F.lit(" Harbour Road")).alias("ship_address"),
            F.concat(F.lit("City "), area.cast("string")).alias("ship_city"),
            F.lit(None).cast("string").alias("ship_region"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("ship_postal_code"),
            pick(fixed_values.COUNTRIES, area).alias("ship_country"),
        )

    @property
    def order_details(self) -> DataFrame:
        """Lines. Prices are whole hundredths of a cent, so they are taken over as integers and
        scaled to decimals: exact, and cheaper than reading each double as decimal text."""
        scale = F.lit("0.0001").cast("decimal(4,4)")
        whole = self.file("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("price_units"),
            F.rint(F.col("l_discount") * 100).cast("int").alias("discount_points"),
        )
        per_unit = F.expr("(2 * price_units + quantity) div nullif(2 * quantity, 0)")
        discount = (F.col("discount_points") * 25).cast("decimal(6,0)") * F.lit("0.001").cast(
            "decimal(3,3)"
        )
        return whole.select(
            "order_id",
            "product_id",
            (per_unit.cast("decimal(14,0)") * scale).cast("decimal(14,4)").alias("unit_price"),
            "quantity",
            discount.cast("decimal(5,3)").alias("discount"),
            (F.col("price_units").cast("decimal(14,0)") * scale)
            .cast("decimal(16,4)")
            .alias("line_subtotal"),
        )

    @property
    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        category = _lookup(((c[1], c[0]) for c in fixed_values.CATEGORIES), F.col("p_type"))
        return self.file("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            (key % 10).alias("supplier_id"),
            category.alias("category_id"),
            F.col("p_brand").alias("quantity_per_unit"),
            (_cents("p_retailprice", 10) * (1 + size % 7)).cast("decimal(18,4)").alias("unit_price"),
            ((key * 7 + 3) % 60).cast("int").alias("units_in_stock"),
            (key % 3 * 10).cast("int").alias("units_on_order"),
            (size % 30).cast("int").alias("reorder_level"),
            (key % 10 == 0).alias("discontinued"),
        )

    @property
    def categories(self) -> DataFrame:
        rows = readers.literal_rows(
            self.spark,
            fixed_values.CATEGORIES,
            "category_id int, category_name string, description string",
        )
        return F.broadcast(rows)

    @property
    def employees(self) -> DataFrame:
        rows = readers.literal_rows(
            self.spark,
            fixed_values.EMPLOYEES,
            "employee_id int, last_name string, first_name string, title string",
        )
        return F.broadcast(rows)

    @property
    def shippers(self) -> DataFrame:
        rows = readers.literal_rows(
            self.spark,
            fixed_values.SHIPPERS,
            "shipper_id int, company_name string, phone string",
        )
        return F.broadcast(rows)

    @property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        title = _lookup(fixed_values.CONTACT_TITLES.items(), F.col("c_mktsegment"))
        # One row per nation: a fixed 25, and Spark checks the size before it broadcasts.
        nations = self.file("nation").select("n_nationkey", F.col("n_name").alias("city"))
        located = self.file("customer").join(
            nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return located.select(
            key.alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.concat(F.lit("Contact "), key.cast("string")).alias("contact_name"),
            title.alias("contact_title"),
            F.concat((key % 100).cast("string"), F.lit(" Market Street")).alias("address"),
            F.col("city"),
            F.lit(None).cast("string").alias("region"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("postal_code"),
            pick(fixed_values.COUNTRIES, F.col("c_nationkey")).alias("country"),
            F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
            F.lit(None).cast("string").alias("fax"),
        )

    @property
    def suppliers(self) -> DataFrame:
        return self.file("supplier").select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("company_name"),
            pick(fixed_values.COUNTRIES, F.col("s_nationkey")).alias("country"),
        )

    # Raw activity tables

    @property
    def sales_transactions(self) -> DataFrame:
        key = F.col("event_id")
        return (
            self.file("events")
            .filter(F.col("event_type") == "purchase")
            .select(
                key.alias("transaction_id"),
                "user_id",
                (key % 50).alias("product_id"),
                (F.col("value").cast("decimal(10,2)") * 5).cast("decimal(12,2)").alias("amount"),
                F.lit("USD").alias("currency"),
                F.col("ts").alias("transaction_date"),
                F.when(key % 10 == 3, "failed").otherwise("completed").alias("status"),
                F.col("ts").alias("created_at"),
            )
        )

    @property
    def user_events(self) -> DataFrame:
        key = F.col("event_id")
        page = F.concat(F.lit("/p"), F.get_json_object("props", "$.k"))
        session = F.concat(F.lit("s"), (F.col("user_id") % 50).cast("string"))
        client = F.struct(
            pick(fixed_values.BROWSERS, key % 4).alias("browser"),
            pick(fixed_values.DEVICES, key % 3).alias("device"),
        )
        return self.file("events").select(
            "event_id",
            "user_id",
            "event_type",
            F.col("ts").alias("event_timestamp"),
            F.to_json(
                F.struct(
                    page.alias("page"), session.alias("session_id"), client.alias("metadata")
                )
            ).alias("event_data"),
            F.col("ts").alias("created_at"),
        )

    @property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        start = F.lit("2023-01-01").cast("date")
        return self.file("customer").select(
            key.alias("user_id"),
            F.lower("c_name").alias("username"),
            F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.date_add(start, (key % 365).cast("int")).cast("string").alias("registration_date"),
            pick(fixed_values.COUNTRIES, F.col("c_nationkey")).alias("country"),
        )

    @property
    def catalog_products(self) -> DataFrame:
        """The product list of the activity tables: id, name, category, price."""
        return self.file("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            _cents("p_retailprice", 10).cast("decimal(14,4)").alias("price"),
        )

    # Declared sources

    SOURCES = {
        "raw": {
            "sales_transactions": "sales_transactions",
            "user_events": "user_events",
            "product_catalog": "catalog_products",
        },
        "trading": {
            name: name
            for name in (
                "orders",
                "order_details",
                "products",
                "categories",
                "customers",
                "suppliers",
                "employees",
                "shippers",
            )
        },
    }

    def table(self, source: str, name: str) -> DataFrame:
        """A declared source table."""
        return getattr(self, self.SOURCES[source][name])

    def register_views(self, prefix: str = "") -> list[str]:
        """Make every declared table visible to ``spark.sql`` and return the view names."""
        names = []
        for source, members in self.SOURCES.items():
            for name in members:
                self.table(source, name).createOrReplaceTempView(f"{prefix}{name}")
                names.append(f"{prefix}{name}")
        return names
