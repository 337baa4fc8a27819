"""Star schema, loads and gold aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.functions.masking import mask_columns, mask_hash
from lakestrata.operators.aggregates import row_counts
from lakestrata.operators.asof import asof_join
from lakestrata.operators.load import insert_if_absent, new_rows, upsert
from lakestrata.plans import gold, star
from lakestrata.plans.consolidate import consolidate
from lakestrata.settings import work_path
from lakestrata.sinks.star import load_star, read_star
from lakestrata.sources.domain import domain_tables, money, table
from lakestrata.workload.joins import DEMO_KEY
from lakestrata.workload.registry import query, with_domain

FACT = """
fact AS (
  SELECT * FROM (
    SELECT i.order_id, o.customer_id AS cliente_id, i.product_id AS produto_id,
           order_purchase_timestamp AS data_venda, price AS valor_total, 1 AS quantidade,
           row_number() OVER (PARTITION BY i.order_id, i.product_id, order_item_id ORDER BY price) AS rn
    FROM d_customers c JOIN d_orders o ON c.customer_id = o.customer_id JOIN d_items i ON o.order_id = i.order_id)
  WHERE rn = 1)"""


def star_tables(spark, sf_dir):
    """Masked star: one row per item, so payments do not multiply sales."""
    tables = domain_tables(spark, sf_dir)
    tables["customers"] = mask_columns(tables["customers"], key=DEMO_KEY)
    wide = consolidate(tables, driving="customers", mode="preaggregate")
    return star.build_star_from_tables(tables, wide)


@query("build_dim_cliente", with_domain(f"""
SELECT customer_id AS cliente_id, customer_unique_id AS nome, customer_segment AS segmento,
       '[CIDADE_REMOVIDA_LGPD]' AS cidade, sha256(customer_state || '{DEMO_KEY}') AS estado FROM d_customers"""))
def build_dim_cliente(spark, sf_dir):
    wide = mask_columns(consolidate(domain_tables(spark, sf_dir), mode="preaggregate"), key=DEMO_KEY)
    return star.build_star(wide)["dim_cliente"]


@query("build_dim_produto", with_domain("""
SELECT r.product_id AS produto_id, product_category_name AS nome_produto, product_category_name AS categoria,
       CAST(min(price) AS DOUBLE) AS preco_unitario
FROM d_products r JOIN d_items i ON i.product_id = r.product_id JOIN d_orders o ON i.order_id = o.order_id
GROUP BY 1, 2, 3"""))
def build_dim_produto(spark, sf_dir):
    wide = consolidate(domain_tables(spark, sf_dir), mode="preaggregate")
    return star.build_star(wide)["dim_produto"]


@query("build_fato_vendas", with_domain("""
SELECT order_id, cliente_id, produto_id, data_venda, CAST(valor_total AS DOUBLE) AS valor_total, quantidade FROM fact""", FACT))
def build_fato_vendas(spark, sf_dir):
    return star_tables(spark, sf_dir)["fato_vendas"]


@query("fato_vendas_legacy_grain", with_domain("""
SELECT * EXCLUDE rn FROM (
  SELECT i.order_id, o.customer_id AS cliente_id, i.product_id AS produto_id, order_purchase_timestamp AS data_venda,
         CAST(price AS DOUBLE) AS valor_total, order_item_id AS quantidade,
         row_number() OVER (PARTITION BY i.order_id ORDER BY price, i.product_id, order_item_id) AS rn
  FROM d_customers c JOIN d_orders o ON c.customer_id = o.customer_id JOIN d_items i ON o.order_id = i.order_id)
WHERE rn = 1"""))
def fato_vendas_legacy_grain(spark, sf_dir):
    """One row per order: the first item wins, as with a conflict on order_id."""
    wide = consolidate(domain_tables(spark, sf_dir), mode="preaggregate")
    order = ("price", "order_purchase_timestamp", "product_id")
    return star.build_fato_vendas(wide, star.LEGACY_GRAIN, order, star.LEGACY_QUANTITY)


@query("fact_losses", with_domain("""
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS incomplete, count(*) - (SELECT count(*) FROM fact) AS merged,
       (SELECT count(*) FROM fact) AS kept FROM d_items""", FACT))
def fact_losses(spark, sf_dir):
    """What the fact makes of the rows of orders with items."""
    tables = domain_tables(spark, sf_dir, "orders", "items")
    return star.fact_losses(tables["orders"].join(tables["items"], "order_id"))


@query("star_load_counts", with_domain("""
SELECT 'dim_cliente' AS "table", count(*) AS n_rows FROM d_customers
UNION ALL SELECT 'dim_produto', count(*) FROM d_products UNION ALL SELECT 'fato_vendas', count(*) FROM fact""", FACT))
def star_load_counts(spark, sf_dir):
    """Publish the star as one version and read the published tables back."""
    root = work_path(spark, "star")
    load_star(spark, star_tables(spark, sf_dir), root, "v20240101000000")
    return row_counts(read_star(spark, root))


@query("insert_new_rows", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def insert_new_rows(spark, sf_dir):
    """Customers the target (buyers with pending orders) lacks."""
    buyers = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    batch = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return new_rows(buyers, batch.unionByName(batch), ["c_custkey"], ["c_name"])


@query("insert_null_keys", """
WITH t AS (SELECT nullif(o_custkey % 10, 0) AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 3 = 0),
b AS (SELECT nullif(o_custkey % 20, 0) AS k, o_orderpriority AS v FROM orders)
SELECT * FROM t UNION ALL (SELECT k, min(v) FROM b WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM t WHERE k IS NOT NULL) GROUP BY k)
UNION ALL (SELECT DISTINCT k, v FROM b WHERE k IS NULL AND v NOT IN (SELECT v FROM t WHERE k IS NULL))""")
def insert_null_keys(spark, sf_dir):
    """Rows without a key are known by their whole row."""
    return insert_if_absent(*_null_key_batches(spark, sf_dir), ["k"], ["v"])


@query("upsert_null_keys", """
WITH t AS (SELECT nullif(o_custkey % 10, 0) AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 3 = 0),
b AS (SELECT nullif(o_custkey % 20, 0) AS k, o_orderpriority AS v FROM orders)
SELECT * FROM t WHERE k IS NULL OR k NOT IN (SELECT k FROM b WHERE k IS NOT NULL)
UNION ALL (SELECT k, min(v) FROM b WHERE k IS NOT NULL GROUP BY k)
UNION ALL (SELECT DISTINCT k, v FROM b WHERE k IS NULL AND v NOT IN (SELECT v FROM t WHERE k IS NULL))""")
def upsert_null_keys(spark, sf_dir):
    return upsert(*_null_key_batches(spark, sf_dir), ["k"], ["v"])


def _null_key_batches(spark, sf_dir):
    """A target and a batch whose keys repeat and are sometimes NULL."""
    orders = table(spark, sf_dir, "orders")
    target = orders.where("o_orderkey % 3 = 0").select(
        F.expr("nullif(o_custkey % 10, 0)").alias("k"), F.col("o_orderstatus").alias("v")
    )
    batch = orders.select(F.expr("nullif(o_custkey % 20, 0)").alias("k"), F.col("o_orderpriority").alias("v"))
    return target, batch


BATCHES = """
t AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer WHERE c_mktsegment <> 'BUILDING'),
b AS (SELECT o_custkey AS id, first(o_orderpriority ORDER BY o_orderkey) AS name,
             first(o_totalprice ORDER BY o_orderkey) AS amount FROM orders GROUP BY 1)"""


def _target_and_batch(spark, sf_dir):
    target = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    batch = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"), "o_orderkey",
    )
    return target, batch


@query("insert_if_absent", f"WITH {BATCHES} SELECT * FROM t UNION ALL SELECT * FROM b WHERE id NOT IN (SELECT id FROM t)")
def insert_absent(spark, sf_dir):
    """Customers, plus the first order of each buyer the target lacks."""
    return insert_if_absent(*_target_and_batch(spark, sf_dir), ["id"], ["o_orderkey"])


@query("upsert", f"WITH {BATCHES} SELECT * FROM t WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT * FROM b")
def upsert_rows(spark, sf_dir):
    return upsert(*_target_and_batch(spark, sf_dir), ["id"], ["o_orderkey"])


GOLD = """
SELECT estado, categoria, mes, CAST(grouping(estado, categoria, mes) AS INTEGER) AS nivel,
       CAST(sum(valor_total) AS DOUBLE) AS valor_total, CAST(sum(quantidade) AS BIGINT) AS quantidade,
       count(*) AS linhas
FROM (SELECT f.*, sha256(customer_state || '{key}') AS estado, product_category_name AS categoria,
             strftime(data_venda, '%Y-%m-01') AS mes
      FROM fact f LEFT JOIN d_customers c ON f.cliente_id = c.customer_id
      LEFT JOIN d_products p ON f.produto_id = p.product_id)
GROUP BY {how}(estado, categoria, mes)"""


@query("gold_sales_rollup", with_domain(GOLD.format(key=DEMO_KEY, how="ROLLUP"), FACT))
def gold_sales_rollup(spark, sf_dir):
    s = star_tables(spark, sf_dir)
    return gold.gold_sales(s["fato_vendas"], s["dim_cliente"], s["dim_produto"])


@query("gold_sales_cube", with_domain(GOLD.format(key=DEMO_KEY, how="CUBE"), FACT))
def gold_sales_cube(spark, sf_dir):
    s = star_tables(spark, sf_dir)
    return gold.gold_sales(s["fato_vendas"], s["dim_cliente"], s["dim_produto"], how="cube")


def _correlation_sql(lag):
    return with_domain(f"""
SELECT count(*) AS months, round(corr(CAST(valor_total AS DOUBLE), indicador), 6) AS correlation
FROM (SELECT date_trunc('month', order_purchase_timestamp) AS mes, sum(price) AS valor_total
      FROM d_orders o JOIN d_items i ON o.order_id = i.order_id GROUP BY 1)
JOIN (SELECT date_trunc('month', l_shipdate) + to_months({lag}) AS mes, avg(CAST(l_tax AS DECIMAL(18,6))) AS indicador
      FROM lineitem GROUP BY 1) USING (mes)""")


def _correlation(spark, sf_dir, lag):
    """Monthly sales beside an indicator feed of (data, valor) texts."""
    tables = domain_tables(spark, sf_dir, "orders", "items")
    sales = tables["orders"].join(tables["items"], "order_id").groupBy(
        F.to_date(F.date_trunc("month", "order_purchase_timestamp")).alias("mes")
    ).agg(F.sum("price").alias("valor_total"))
    feed = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("data"), F.col("l_tax").cast("string").alias("valor")
    )
    return gold.indicator_correlation(sales, gold.indicator_by_month(feed), lag)


@query("indicator_correlation", _correlation_sql(0))
def correlation(spark, sf_dir):
    return _correlation(spark, sf_dir, 0)


@query("indicator_correlation_lagged", _correlation_sql(3))
def correlation_lagged(spark, sf_dir):
    return _correlation(spark, sf_dir, 3)


@query("monthly_sales", with_domain("""
SELECT strftime(data_venda, '%Y-%m-01') AS mes, CAST(sum(valor_total) AS DOUBLE) AS valor_total
FROM fact GROUP BY 1""", FACT))
def monthly(spark, sf_dir):
    return gold.monthly_sales(star_tables(spark, sf_dir)["fato_vendas"])


@query("regional_weather", f"""
WITH s AS (SELECT sha256(n_name || '{DEMO_KEY}') AS estado, strftime(o_orderdate, '%Y-%m-%d') AS dia,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS valor_total, count(*) AS vendas
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
w AS (SELECT sha256(n_name || '{DEMO_KEY}') AS estado, strftime(l_shipdate, '%Y-%m-%d') AS dia,
             avg(l_quantity) AS temperatura, count(*) AS medicoes
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT estado, dia, CAST(valor_total AS DOUBLE) AS valor_total, vendas, round(temperatura, 6) AS temperatura, medicoes
FROM s LEFT JOIN w USING (estado, dia)""")
def regional_weather(spark, sf_dir):
    """Sales per masked state and day beside the weather of that state."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders")
    sales = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        mask_hash(F.col("n_name"), DEMO_KEY).alias("estado"),
        F.to_date("o_orderdate").alias("dia"), money(F.col("o_totalprice")).alias("valor_total"),
    )
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    weather = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("n_name").alias("estado"), F.to_date("l_shipdate").alias("dia"), F.col("l_quantity").alias("temperatura")
    )
    out = gold.regional_weather(sales, weather, DEMO_KEY)
    return out.withColumn("temperatura", F.round("temperatura", 6))


@query("weather_at_sale", """
WITH s AS (SELECT o_orderkey, n_name AS estado, CAST(o_orderdate AS TIMESTAMP) AS vendido_em
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
r AS (SELECT n_name AS estado, CAST(l_shipdate AS TIMESTAMP) AS medido_em, round(avg(l_quantity), 6) AS temperatura
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT o_orderkey, s.estado, vendido_em, medido_em, temperatura
FROM s ASOF LEFT JOIN r ON s.estado = r.estado AND s.vendido_em >= r.medido_em""")
def weather_at_sale(spark, sf_dir):
    """Each sale with the last reading of its state at that time or before."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("estado"))
    sales = (
        table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "estado", F.col("o_orderdate").cast("timestamp_ntz").alias("vendido_em"))
    )
    readings = (
        table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("estado", F.col("l_shipdate").cast("timestamp_ntz").alias("medido_em"))
        .agg(F.round(F.avg("l_quantity"), 6).alias("temperatura"))
    )
    return asof_join(sales, readings, ["estado"], "vendido_em", "medido_em", ["temperatura"], bucket_seconds=30 * 86_400)


@query("lineage_rows", with_domain("""
SELECT 'consolidate' AS stage, 'customers, items, orders' AS inputs,
       (SELECT count(*) FROM d_customers) + (SELECT count(*) FROM d_items) + (SELECT count(*) FROM d_orders) AS input_rows,
       (SELECT count(*) FROM d_customers c LEFT JOIN d_orders o ON c.customer_id = o.customer_id
        LEFT JOIN d_items i ON o.order_id = i.order_id) AS output_rows
UNION ALL SELECT 'fact', 'items', (SELECT count(*) FROM d_items), (SELECT count(*) FROM fact)""", FACT))
def lineage_rows(spark, sf_dir):
    tables = domain_tables(spark, sf_dir)
    wide = consolidate(tables, mode="preaggregate")
    inputs = {name: tables[name] for name in ("customers", "orders", "items")}
    fact = star.build_fato_vendas(wide)
    return gold.lineage([("consolidate", inputs, wide), ("fact", {"items": tables["items"]}, fact)])
