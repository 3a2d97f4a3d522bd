"""Joins and keyed updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...constants import AIRPORT_CITIES
from ...operators import anti_join, equi_join, lookup_with_default, reconcile, semi_join
from .base import flights, over_flights, register, table
from .event_flights import event_predictions


@register("""
SELECT l_orderkey, l_linenumber, l_partkey, p_partkey, p_name, p_brand AS brand
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber = p_size
""")
def join_left(spark, sf_dir):
    """Left join on two columns with differing names and a renamed right column."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    return equi_join(
        lines,
        parts,
        {"l_partkey": "p_partkey", "l_linenumber": "p_size"},
        "left",
        rename_right={"p_brand": "brand"},
    ).drop("p_size")


@register("""
SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def join_inner(spark, sf_dir):
    """Order lines with their order, right key dropped."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return equi_join(lines, orders, {"l_orderkey": "o_orderkey"}, "inner", drop_right_keys=True)


@register("""
SELECT l_orderkey, l_linenumber, o_orderkey, o_custkey
FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey
""")
def join_right(spark, sf_dir):
    """All orders, with lines where there are any; the lines of one order may be many."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return equi_join(lines, orders, {"l_orderkey": "o_orderkey"}, "right", hot_side="left")


@register("""
SELECT coalesce(c.key, o.key) AS key, c_name, o_orderkey
FROM (SELECT c_custkey AS key, c_name FROM customer WHERE c_acctbal > 0) c
FULL JOIN (SELECT o_custkey AS key, o_orderkey FROM orders) o ON c.key = o.key
""")
def join_outer(spark, sf_dir):
    """Full outer join on a key with one name on both sides."""
    customers = table(spark, sf_dir, "customer").filter("c_acctbal > 0").selectExpr("c_custkey AS key", "c_name")
    orders = table(spark, sf_dir, "orders").selectExpr("o_custkey AS key", "o_orderkey")
    return equi_join(customers, orders, {"key": "key"}, "outer")


@register(over_flights("""
SELECT f.flight_id, f.status, s.n FROM flights f
LEFT JOIN (SELECT status, count(*) AS n FROM flights GROUP BY status) s ON f.status IS NOT DISTINCT FROM s.status
"""))
def join_null_safe(spark, sf_dir):
    """NULL status matches NULL status; the right side has one row per status."""
    rows = flights(spark, sf_dir).select("flight_id", "status")
    sizes = rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return equi_join(rows, sizes, {"status": "status"}, "left", null_safe=True)


@register("""
SELECT o.o_orderkey AS o_orderkey_x, o.o_custkey, o.o_totalprice AS o_totalprice_x,
       m.o_orderkey AS o_orderkey_y, m.o_totalprice AS o_totalprice_y
FROM orders o JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey, max(o_totalprice) AS o_totalprice
                    FROM orders GROUP BY o_custkey) m ON o.o_custkey = m.o_custkey
""")
def join_suffixes(spark, sf_dir):
    """Shared names that are not keys get suffixes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    largest = orders.groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.max("o_totalprice").alias("o_totalprice")
    )
    return equi_join(orders, largest, {"o_custkey": "o_custkey"}, "inner")


@register(over_flights("""
SELECT flight_id, flight_number, origin_airport FROM flights
WHERE (flight_number, origin_airport) IN (
  SELECT flight_number, origin_airport FROM predictions WHERE is_delayed AND flight_date = DATE '2024-01-15')
"""))
def semi_delayed(spark, sf_dir):
    """Flights whose number and origin were predicted late on one day."""
    rows = flights(spark, sf_dir)
    late = event_predictions(rows).filter("is_delayed AND flight_date = DATE'2024-01-15'")
    on = {"flight_number": "flight_number", "origin_airport": "origin_airport"}
    return semi_join(rows, late, on, as_text=True).select("flight_id", "flight_number", "origin_airport")


@register("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)
""")
def anti_customers(spark, sf_dir):
    """Customers without a large order; the orders are reduced to one row per customer first."""
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 250000")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return anti_join(customers, large, {"c_custkey": "o_custkey"})


@register(over_flights("""
SELECT f.flight_id, CASE WHEN p.flight_number IS NOT NULL THEN p.is_delayed ELSE f.k > 90 END AS is_delayed_predicted
FROM flights f LEFT JOIN predictions p
  ON f.flight_number = p.flight_number AND f.date = p.flight_date AND f.origin_airport = p.origin_airport
"""))
def reconcile_predictions(spark, sf_dir):
    """Predictions brought back to flights; others keep their earlier value."""
    rows = flights(spark, sf_dir)
    earlier = rows.select(
        "flight_id", "flight_number", "date", "origin_airport", (F.col("k") > 90).alias("is_delayed_predicted")
    )
    return reconcile(earlier, event_predictions(rows)).select("flight_id", "is_delayed_predicted")


@register(over_flights("""
SELECT flight_id, CASE airport WHEN 'NCE' THEN 'Nice' WHEN 'TLS' THEN 'Toulouse' WHEN 'LYS' THEN 'Lyon'
  WHEN 'MRS' THEN 'Marseille' WHEN 'BOD' THEN 'Bordeaux' WHEN 'CDG' THEN 'Paris Charles de Gaulle'
  ELSE airport END AS city
FROM (SELECT flight_id, CASE WHEN k % 9 = 0 THEN 'XYZ' ELSE origin_airport END AS airport FROM flights)
"""))
def city_lookup(spark, sf_dir):
    """City of an airport, the code itself when unknown."""
    rows = flights(spark, sf_dir).select(
        "flight_id", F.when(F.col("k") % 9 == 0, "XYZ").otherwise(F.col("origin_airport")).alias("airport")
    )
    return lookup_with_default(rows, "airport", AIRPORT_CITIES, "city").select("flight_id", "city")
