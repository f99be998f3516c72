"""Aggregations and what is computed from their buckets."""

from pyspark.sql import functions as F

from docspark.functions import geo
from docspark.operators import aggs
from docspark.plans import criteria as C
from docspark.plans.search import Order
from docspark.sources.rollup import RANK_ERROR, Rollup
from docspark.sources.sql import sql

from .predicates import documents, orders
from .registry import lat_sql, located, lon_sql, query, scratch, tok


@query("terms_agg", """SELECT l_partkey AS key, count(*) AS doc_count FROM lineitem GROUP BY 1
    ORDER BY doc_count DESC, key LIMIT 10""")
def _(t):
    return aggs.terms_agg(t.lineitem, "l_partkey", 10)


@query("terms_agg_multi", f"""SELECT key, count(*) AS doc_count FROM
    (SELECT unnest(list_distinct({tok('text')})) AS key FROM documents) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def _(t):
    from docspark.functions.analysis import tokens
    return aggs.terms_agg(t.documents.select(tokens("text").alias("w")), "w", 25)


@query("terms_other_count", """WITH b AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
    top AS (SELECT n FROM b ORDER BY n DESC, k LIMIT 10)
    SELECT ((SELECT sum(n) FROM b) - (SELECT sum(n) FROM top))::BIGINT AS sum_other_doc_count""")
def _(t):
    return aggs.terms_other_count(t.lineitem, "l_partkey")


@query("stats_bucket", """WITH b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT count(*) AS count, min(n) AS min, max(n) AS max, round(avg(n), 6) AS avg, sum(n)::BIGINT AS sum FROM b""")
def _(t):
    buckets = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("doc_count"))
    return aggs.stats_bucket(buckets).withColumn("avg", F.round("avg", 6))


@query("sql_sum", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def _(t):
    return sql(t.spark, "SELECT round(sum(o_totalprice), 2) AS total FROM orders", {"orders": t.orders})


@query("agg_with_query", """SELECT o_orderpriority AS key, count(*) AS doc_count FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY 1""")
def _(t):
    s = orders(t).query(C.is_("o_orderstatus", "F") & C.gt("o_totalprice", 100000.0))
    return aggs.terms_agg(s.matches(), "o_orderpriority")


@query("aggregate_only", """SELECT lang AS key, count(*) AS doc_count FROM documents GROUP BY 1""")
def _(t):
    return aggs.terms_agg(documents(t).matches(), "lang")


@query("reactive_aggregate", """SELECT event_type AS key, count(*) AS doc_count, round(max(value), 2) AS peak
    FROM events GROUP BY 1""")
def _(t):
    return aggs.terms_agg(t.events, "event_type", metrics=[F.round(F.max("value"), 2).alias("peak")])


@query("metric_aggs", """SELECT l_returnflag, count(l_quantity) AS count, min(l_quantity) AS min, max(l_quantity) AS max,
      round(avg(l_quantity), 6) AS avg, sum(l_quantity) AS sum, sum(l_quantity * l_quantity) AS sum_of_squares,
      round(var_pop(l_quantity), 6) AS variance, round(stddev_pop(l_quantity), 6) AS std_deviation
    FROM lineitem GROUP BY 1""")
def _(t):
    out = t.lineitem.groupBy("l_returnflag").agg(*aggs.extended_stats("l_quantity"))
    return out.withColumns({c: F.round(c, 6) for c in ("avg", "variance", "std_deviation")})


@query("cardinality", "SELECT count(DISTINCT l_partkey) AS value FROM lineitem")
def _(t):
    return aggs.cardinality(t.lineitem, "l_partkey")


@query("cardinality_approx", "SELECT count(DISTINCT l_partkey) AS exact, true AS within FROM lineitem")
def _(t):
    # within five standard errors of the sketch
    near = aggs.cardinality(t.lineitem, "l_partkey", exact=False, rsd=0.02).scalar()
    exact = aggs.cardinality(t.lineitem, "l_partkey").withColumnRenamed("value", "exact")
    return exact.withColumn("within", F.abs(near - F.col("exact")) <= 0.1 * F.col("exact"))


@query("percentiles", """SELECT round(quantile_cont(l_extendedprice, 0.01), 4) AS p1,
      round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
      round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem""")
def _(t):
    p = aggs.percentiles(t.lineitem, "l_extendedprice", (1, 25, 50, 95), exact=True)
    return p.select(*[F.round(c, 4).alias(c) for c in p.columns])


@query("percentiles_by", """SELECT l_returnflag, round(quantile_cont(l_discount, 0.5), 4) AS p50,
    round(quantile_cont(l_discount, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def _(t):
    p = aggs.percentiles(t.lineitem, "l_discount", (50, 90), exact=True, by=["l_returnflag"])
    return p.select("l_returnflag", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


@query("percentiles_approx", "SELECT 50.0::DOUBLE AS point, true AS within UNION ALL SELECT 99.0, true")
def _(t):
    # the share of rows at or below the sketch's value is within its error
    q = aggs.percentiles(t.lineitem, "l_extendedprice", (50, 99)).select(F.struct("p50", "p99").alias("q")).scalar()
    price = F.col("l_extendedprice")
    shares = t.lineitem.agg(F.avg((price <= q["p50"]).cast("double")).alias("s50"), F.avg((price <= q["p99"]).cast("double")).alias("s99"))
    rows = F.array(*[F.struct(F.lit(float(p)).alias("point"), (F.abs(F.col(f"s{p}") - p / 100) <= 0.001).alias("within")) for p in (50, 99)])
    return shares.select(F.explode(rows).alias("r")).select("r.*")


_ROLLED = """SELECT l_returnflag, l_shipdate, l_partkey, l_quantity, l_extendedprice, date_trunc('month', l_shipdate) AS month FROM lineitem"""


@query("rollup", f"""SELECT l_returnflag, count(*) AS doc_count, sum(l_quantity) AS quantity_sum, max(l_quantity) AS quantity_max,
      true AS distinct_within, true AS p90_within FROM ({_ROLLED}) WHERE year(month) IN (1994, 1995, 1996) GROUP BY 1""")
def _(t):
    # stored by flag and month, in two parts; three years of it are read without the table
    rows = t.lineitem.withColumn("month", F.date_trunc("month", "l_shipdate"))
    early = F.col("l_orderkey") % 2 == 0
    rollup = Rollup.build(rows.where(early), scratch(t, "rollup"), keys=["l_returnflag", "month"], distinct=["l_partkey"],
                          quantiles=["l_extendedprice"], metrics=["l_quantity"]).add(rows.where(~early))
    years = F.year("month").isin(1994, 1995, 1996)
    got = rollup.aggregate(["l_returnflag"], where=years, points=(90,))
    # the exact numbers, to hold the sketches against
    joined = rows.where(years).join(got, "l_returnflag")
    price = F.col("l_extendedprice")
    exact = joined.groupBy("l_returnflag").agg(
        F.max("doc_count").alias("doc_count"), F.max("l_quantity_sum").alias("quantity_sum"), F.max("l_quantity_max").alias("quantity_max"),
        (F.abs(F.max("l_partkey_distinct") - F.countDistinct("l_partkey")) <= 5 * 0.0082 * F.countDistinct("l_partkey")).alias("distinct_within"),
        (F.abs(F.avg((price <= F.col("l_extendedprice_p90")).cast("double")) - 0.9) <= 2 * RANK_ERROR).alias("p90_within"))
    return exact


@query("histogram", """WITH b AS (SELECT floor(o_totalprice / 25000)::BIGINT AS i, count(*) AS c FROM orders GROUP BY 1)
    SELECT i * 25000.0::DOUBLE AS key, coalesce(c, 0) AS doc_count
    FROM (SELECT unnest(range((SELECT min(i) FROM b), (SELECT max(i) FROM b) + 1)) AS i) LEFT JOIN b USING (i)""")
def _(t):
    return aggs.histogram(t.orders, "o_totalprice", 25000)


_MONTHS = "m AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS key, count(*) AS doc_count FROM orders GROUP BY 1)"


@query("date_histogram", f"WITH {_MONTHS} SELECT * FROM m")
def _(t):
    return aggs.date_histogram(t.orders, "o_orderdate", "month")


@query("date_histogram_filled", """WITH b AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS k, count(*) AS c FROM events
      WHERE event_type = 'error' AND value > 50 GROUP BY 1)
    SELECT r.k AS key, coalesce(c, 0) AS doc_count FROM
      (SELECT unnest(generate_series((SELECT min(k) FROM b), (SELECT max(k) FROM b), INTERVAL 1 HOUR)) AS k) r
      LEFT JOIN b ON b.k = r.k""")
def _(t):
    return aggs.date_histogram(t.events.where("event_type = 'error' AND value > 50"), "ts", "hour")


@query("range_agg", """SELECT 'cheap' AS key, count(*) FILTER (l_extendedprice < 20000) AS doc_count FROM lineitem
    UNION ALL SELECT 'middle', count(*) FILTER (l_extendedprice >= 10000 AND l_extendedprice < 60000) FROM lineitem
    UNION ALL SELECT 'dear', count(*) FILTER (l_extendedprice >= 60000) FROM lineitem""")
def _(t):
    return aggs.range_agg(t.lineitem, "l_extendedprice", {
        "cheap": (None, 20000.0), "middle": (10000.0, 60000.0), "dear": (60000.0, None)})


@query("filter_aggs", """SELECT 'returned' AS key, count(*) FILTER (l_returnflag = 'R') AS doc_count,
      sum(l_quantity) FILTER (l_returnflag = 'R') AS quantity FROM lineitem
    UNION ALL SELECT 'open', count(*) FILTER (l_linestatus = 'O'), sum(l_quantity) FILTER (l_linestatus = 'O') FROM lineitem""")
def _(t):
    return aggs.filter_aggs(t.lineitem, {"returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O"},
                            {"quantity": F.col("l_quantity")})


@query("sub_aggs", """SELECT l_returnflag, l_linestatus, count(*) AS doc_count, sum(l_quantity) AS quantity,
    grouping(l_returnflag) * 2 + grouping(l_linestatus) AS _level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def _(t):
    return aggs.sub_aggs(t.lineitem, ["l_returnflag", "l_linestatus"], [F.sum("l_quantity").alias("quantity")], totals=True)


@query("nested_buckets", """WITH p AS (SELECT o_orderpriority AS key, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, o_custkey) AS r FROM p)
    SELECT key, (SELECT count(*) FROM orders o WHERE o.o_orderpriority = r.key) AS doc_count,
      string_agg(o_custkey || ':' || n, ' ' ORDER BY r) AS inner_buckets FROM r WHERE r <= 5 GROUP BY key""")
def _(t):
    b = aggs.nested_buckets(t.orders, "o_orderpriority", "o_custkey", inner_size=5)
    text = F.array_join(F.transform("buckets", lambda x: F.concat(x["key"].cast("string"), F.lit(":"), x["doc_count"].cast("string"))), " ")
    return b.select("key", "doc_count", text.alias("inner_buckets"))


@query("top_hits", """SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
    (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 4""")
def _(t):
    h = aggs.top_hits(t.orders, "o_orderpriority", (F.desc("o_totalprice"), F.asc("o_orderkey")), 4)
    return h.select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("missing_agg", "SELECT count(*) AS doc_count FROM events WHERE NOT coalesce(value > 20, false)")
def _(t):
    return aggs.missing_agg(t.events.withColumn("value", F.when(F.col("value") > 20, F.col("value"))), "value")


def _months(t):
    return aggs.date_histogram(t.orders, "o_orderdate", "month")


@query("bucket_cumulative_sum", f"""WITH {_MONTHS} SELECT key, doc_count, (sum(doc_count) OVER (ORDER BY key))::BIGINT
    AS cumulative FROM m""")
def _(t):
    return aggs.cumulative_sum(_months(t))


@query("bucket_derivative", f"WITH {_MONTHS} SELECT key, doc_count, doc_count - lag(doc_count) OVER (ORDER BY key) AS derivative FROM m")
def _(t):
    return aggs.derivative(_months(t), "1 month")


@query("bucket_moving_average", f"""WITH {_MONTHS} SELECT key, doc_count, round(avg(doc_count) OVER
    (ORDER BY key ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS moving_avg FROM m""")
def _(t):
    return aggs.moving_average(_months(t), "1 month", 3).withColumn("moving_avg", F.round("moving_avg", 6))


@query("bucket_sort", f"WITH {_MONTHS} SELECT * FROM m ORDER BY doc_count DESC, key LIMIT 5 OFFSET 2")
def _(t):
    return aggs.bucket_sort(_months(t), (F.desc("doc_count"), F.asc("key")), 5, 2)


@query("geo_bounds", f"""SELECT max({lat_sql('c_custkey')})::DOUBLE AS top, min({lon_sql('c_custkey')})::DOUBLE AS "left",
    min({lat_sql('c_custkey')})::DOUBLE AS bottom, max({lon_sql('c_custkey')})::DOUBLE AS "right" FROM customer""")
def _(t):
    return aggs.geo_bounds(located(t.customer, "c_custkey"), "location")


@query("geohash_grid", f"""SELECT floor(({lat_sql('c_custkey')}::DOUBLE + 90) / 45)::BIGINT AS row_,
    floor(({lon_sql('c_custkey')}::DOUBLE + 180) / 45)::BIGINT AS col_, count(*) AS doc_count FROM customer GROUP BY 1, 2""")
def _(t):
    df = located(t.customer, "c_custkey")
    df = df.withColumn("cell", geo.geohash(F.col("location.lat"), F.col("location.lon"), 1))
    grid = aggs.geohash_grid(df, "cell")
    box = geo.cell_bounds(F.col("key"), 1)
    # a one-digit cell is 45 degrees high and wide
    return grid.select(F.floor((box["bottom"] + 90) / 45).alias("row_"),
                       F.floor((box["left"] + 180) / 45).alias("col_"), "doc_count")
