"""Stock queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.analytics import inventory
from millrace.queries import inputs
from millrace.queries.inputs import POS_SQL
from millrace.queries.registry import query

STOCK_COLUMNS = """
  store_id, item_id, name, snapshot_quantity, change_quantity, current_inventory,
  strftime(last_inventory_date, '%Y-%m-%d %H:%M:%S.%f') AS last_inventory_date,
  strftime(last_change_quantity_date, '%Y-%m-%d %H:%M:%S.%f') AS last_change_quantity_date"""

KEPT_SQL = """
kept AS (
  SELECT x.store_id, x.item_id, x.date_time, x.quantity
  FROM change x JOIN store y ON x.store_id = y.store_id
  WHERE NOT (y.name = 'online' AND x.change_type = 'bopis'))
"""

def stock_sql(inputs_sql, every_store=False):
    """Pairs of item and store with their last count and what moved since; DISTINCT folds the
    pairs without a count into one row, unless every store is wanted."""
    store = "store.store_id" if every_store else "n.store_id"
    since = "n.date_time IS NULL OR k.date_time >= n.date_time" if every_store else "k.date_time >= n.date_time"
    how = "LEFT JOIN" if every_store else "JOIN"
    return f"""
WITH {inputs_sql}, {KEPT_SQL},
pair AS (SELECT {store} AS store_id, item.item_id, item.name, n.quantity, n.date_time
         FROM item CROSS JOIN store LEFT JOIN latest n ON n.item_id = item.item_id AND n.store_id = store.store_id),
later AS (SELECT k.item_id, k.store_id, sum(k.quantity) AS moved, max(k.date_time) AS moved_at
          FROM kept k {how} latest n ON n.item_id = k.item_id AND n.store_id = k.store_id WHERE {since} GROUP BY ALL),
stock AS (
  SELECT DISTINCT pair.store_id, pair.item_id, name, CAST(coalesce(quantity, 0) AS BIGINT) AS snapshot_quantity,
         CAST(coalesce(moved, 0) AS BIGINT) AS change_quantity,
         CAST(coalesce(quantity, 0) + coalesce(moved, 0) AS BIGINT) AS current_inventory,
         date_time AS last_inventory_date, greatest(date_time, moved_at) AS last_change_quantity_date
  FROM pair LEFT JOIN later ON later.item_id = pair.item_id AND later.store_id = pair.store_id)
SELECT {STOCK_COLUMNS} FROM stock
"""


STOCK_SQL = stock_sql(POS_SQL)
FIXED_SQL = stock_sql(POS_SQL, every_store=True)


@query("i1_current_stock", STOCK_SQL)
def i1(t):
    return inventory.current_stock(
        inputs.items(t), inputs.stores(t), inputs.snapshots(t), inputs.changes(t))


@query("i1_current_stock_each_store", FIXED_SQL)
def i1_fixed(t):
    return inventory.current_stock(
        inputs.items(t), inputs.stores(t), inputs.snapshots(t), inputs.changes(t), mode="fixed")


@query("i2_latest_snapshot", f"""
WITH {POS_SQL}
SELECT item_id, store_id, strftime(date_time, '%Y-%m-%d %H:%M:%S.%f') AS date_time, quantity FROM latest
""")
def i2(t):
    return inventory.latest_snapshots(inputs.snapshots(t))


@query("i3_transaction_documents_round_trip", """
SELECT CAST(l_orderkey AS VARCHAR) AS trans_id, l_partkey AS item_id,
       CAST(l_quantity AS INTEGER) AS quantity, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def i3(t):
    """Item rows -> documents -> item rows keeps every row and its multiplicity."""
    docs = inventory.transaction_documents(pos_rows(t))
    return inventory.item_rows(docs).groupBy("trans_id", "item_id", "quantity").agg(
        F.count("*").alias("n"))


def pos_rows(t):
    return t.lineitem.select(
        F.concat(F.lit("{"), F.col("l_orderkey").cast("string"), F.lit("}")).alias("trans_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_suppkey") % 5).cast("int").alias("store_id"),
        F.col("l_shipdate").alias("date_time"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).cast("bigint").alias("change_type_id"),
    )


@query("a10_items_per_transaction", """
SELECT CAST(l_orderkey AS VARCHAR) AS trans_id, 0 AS part, count(*) AS n_items,
       string_agg(CAST(l_partkey AS VARCHAR) || 'x' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ','
                  ORDER BY l_partkey, CAST(l_quantity AS INTEGER)) AS items,
       strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS date_time,
       CAST(min(CAST(l_suppkey % 5 AS INTEGER)) AS INTEGER) AS store_id
FROM lineitem GROUP BY l_orderkey
""")
def a10(t):
    docs = inventory.transaction_documents(pos_rows(t))
    text = F.expr("array_join(transform(items, i -> concat(i.item_id, 'x', i.quantity)), ',')")
    return docs.select("trans_id", "part", F.size("items").cast("bigint").alias("n_items"),
                       text.alias("items"), "date_time", "store_id")
