"""Functions stored in a layer, called from SQL."""

import uuid

from registry import jobs, scalars  # noqa: F401  (their statements are shared)
from registry.history import full_run
from registry.sinks import RUN, _database
from tillworks.functions import published
from tillworks.sinks import tables as sinks


def _named(t, table):
    """A file as a view of its own name."""
    name = f"{table}_{uuid.uuid4().hex}"
    sinks.publish_view(t.file(table), name)
    return name


def _functions(t):
    # Not dropped before: the session remembers a function, and replaces it.
    database = f"functions_{RUN}"
    published.publish_functions(t.spark, database)
    return database


@full_run("f23b_cents_function", of="f23_cents_to_dollars")
def cents_function(t):
    layer = _functions(t)
    return t.spark.sql(
        f"""SELECT p_partkey AS product_id, {layer}.cents_to_dollars(p_retailprice) AS dollars
            FROM {_named(t, "part")}"""
    )


@full_run("k08b_layer_function", of="k08_layer_names")
def layer_function(t):
    layer = _functions(t)
    of = "CASE n_regionkey % 3 WHEN 0 THEN ' staging ' WHEN 1 THEN 'marts' END"
    return t.spark.sql(
        f"""SELECT n_nationkey, n_name, {layer}.layer_name('retail', {of}, false) AS apart,
                   {layer}.layer_name('retail', {of}, true) AS live
            FROM {_named(t, "nation")}"""
    )


@full_run("a41b_period_function", of="a41_quarterly_orders")
def period_function(t):
    # The view with its period as arguments, over the stored tables of a layer.
    layer = _database(t, "periods")
    sinks.publish_table(t.customers.select("customer_id", "company_name", "city", "country"), "customers", layer)
    sinks.publish_table(t.orders.select("order_id", "customer_id", "order_date"), "orders", layer)
    published.publish_period_functions(t.spark, layer)
    return t.spark.sql(f"SELECT * FROM {layer}_quarterly_orders(DATE '1997-01-01', DATE '1997-12-31')")
