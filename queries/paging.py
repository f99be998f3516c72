"""Projection, sorting, paging, collapsing."""

from pyspark.sql import functions as F

from docspark.functions import convert
from docspark.operators.collapse import collapse_inner_hits
from docspark.plans import criteria as C
from docspark.plans.search import Order, Search, source_filter
from docspark.schema import DocSchema, FieldSpec

from .predicates import documents, orders, parts
from .registry import Tables, query, tok

# --- projections --------------------------------------------------------------------------------


@query("source_filter", "SELECT doc_id, lang, source FROM documents WHERE lang <> 'en'")
def _(t):
    hits = documents(t).query(~C.is_("lang", "en")).matches()
    return source_filter(hits, ["doc*", "la*", "s*", "n_*"], ["n_chars", "txt"])


@query("source_filter_nested", "SELECT o_orderkey, year(o_orderdate)::INT AS y FROM orders")
def _(t):
    df = t.orders.select("o_orderkey", F.struct(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_totalprice").alias("placed"))
    return source_filter(df, ["o_orderkey", "placed"], ["placed.m", "*price"]).select("o_orderkey", "placed.y")


@query("fields", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def _(t):
    return documents(t).sort(Order("n_chars").desc()).fields("doc_id", "n_chars").hits()


@query("stored_fields", "SELECT p_partkey, p_brand FROM part WHERE p_size > 45")
def _(t):
    return parts(t).query(C.gt("p_size", 45)).unpaged(None).fields("p_partkey", "p_brand").hits()


@query("docvalue_fields", """SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS day,
    printf('%.2f', o_totalprice) AS price FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    hits = orders(t).query(C.is_("o_orderstatus", "P")).matches()
    return hits.select("o_orderkey", convert.format_date(F.col("o_orderdate"), "dd.MM.yyyy").alias("day"),
                       F.format_string("%.2f", "o_totalprice").alias("price"))


@query("script_field", """SELECT p_partkey, round(p_retailprice * 1.19, 3) AS gross FROM part WHERE p_size = 7""")
def _(t):
    s = parts(t).query(C.is_("p_size", 7)).unpaged(None)
    return s.script_field("gross", F.round(F.col("p_retailprice") * F.lit(1.19), 3)).hits().select("p_partkey", "gross")


@query("runtime_field", """SELECT p_partkey, round(p_retailprice / p_size, 4) AS per_size FROM part
    WHERE p_retailprice / p_size > 200""")
def _(t):
    s = parts(t).runtime_field("per_size", "p_retailprice / p_size", "double")
    hits = s.query(C.gt("per_size", 200.0)).matches()
    return hits.select("p_partkey", F.round("per_size", 4).alias("per_size"))


@query("runtime_multi", """SELECT c_custkey FROM customer
    WHERE list_contains([c_mktsegment, substr(c_name, 1, 8)], 'MACHINERY')
       OR list_contains([c_mktsegment, substr(c_name, 1, 8)], 'nobody')""")
def _(t):
    df = t.customer
    s = Search(df, DocSchema.of(df, id="c_custkey"))
    s = s.runtime_field("all_names", F.array("c_mktsegment", F.substring("c_name", 1, 8)))
    return s.query(C.in_("all_names", ["MACHINERY", "nobody"])).matches().select("c_custkey")


@query("scaled_float", "SELECT p_partkey, round(p_retailprice * 0.37 * 10) / 10 AS scaled FROM part")
def _(t):
    return t.part.select("p_partkey", convert.scaled_float(F.col("p_retailprice") * F.lit(0.37), 10).alias("scaled"))


@query("token_count", f"SELECT doc_id, len({tok('text')}) AS n FROM documents")
def _(t):
    from docspark.functions.analysis import token_count
    return t.documents.select("doc_id", token_count("text").cast("long").alias("n"))


@query("field_alias", "SELECT p_partkey, p_name AS title FROM part WHERE p_name LIKE 'hot%'")
def _(t):
    df = t.part
    schema = DocSchema.of(df, id="p_partkey", overrides=[FieldSpec("title", "keyword", "p_name")])
    hits = Search(df, schema).query(C.starts_with("title", "hot")).matches()
    return hits.select("p_partkey", F.col("p_name").alias("title"))


@query("copy_to", """SELECT p_partkey FROM part WHERE list_has_all(
    list_filter(regexp_split_to_array(lower(p_name || ' ' || p_type || ' ' || p_brand), '[^\\p{L}\\p{N}]+'),
    lambda x: x <> ''), ['economy', 'bolt'])""")
def _(t):
    df = t.part.withColumn("everything", F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    s = Search(df, DocSchema.of(df, text=["everything"], id="p_partkey"))
    return s.query(C.matches_all("everything", "economy bolt")).matches().select("p_partkey")


@query("null_value", "SELECT event_id FROM events WHERE NOT coalesce(value >= 5, false)")
def _(t):
    df = t.events.withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    schema = DocSchema.of(df, overrides=[FieldSpec("value", "numeric", null_value=-1.0)])
    return Search(df, schema).query(C.is_("value", -1.0)).matches().select("event_id")


@query("ignore_above", "SELECT doc_id FROM documents WHERE length(text) <= 40")
def _(t):
    df = t.documents
    schema = DocSchema.of(df, overrides=[FieldSpec("text", "keyword", ignore_above=40)])
    return Search(df, schema).query(C.exists("text")).matches().select("doc_id")


@query("normalizer", "SELECT p_partkey FROM part WHERE lower(trim(p_type)) = 'economy'")
def _(t):
    df = t.part.withColumn("p_type", F.lower(F.trim("p_type")))
    schema = DocSchema.of(df, overrides=[FieldSpec("p_type", "keyword", convert=lambda v: v.strip().lower())])
    return Search(df, schema).query(C.is_("p_type", " ECONOMY ")).matches().select("p_partkey")


# --- sorting -----------------------------------------------------------------------------------------


@query("sort", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey LIMIT 50""")
def _(t):
    s = orders(t).sort(Order("o_orderpriority").desc(), Order("o_totalprice")).limit(50)
    return s.hits().select("o_orderkey", "o_totalprice")


def _gappy(t: Tables) -> Search:
    df = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return Search(df, DocSchema.of(df, id="event_id"))


_GAPPY = "(SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"


@query("sort_missing", f"SELECT event_id FROM {_GAPPY} ORDER BY v DESC NULLS LAST, event_id LIMIT 20")
def _(t):
    return _gappy(t).sort(Order("value").desc()).limit(20).hits().select("event_id")


@query("sort_missing_first", f"SELECT event_id FROM {_GAPPY} ORDER BY v NULLS FIRST, event_id LIMIT 20")
def _(t):
    return _gappy(t).sort(Order("value", missing="first")).limit(20).hits().select("event_id")


@query("sort_missing_value", f"SELECT event_id FROM {_GAPPY} ORDER BY coalesce(v, 100.0), event_id LIMIT 3000")
def _(t):
    return _gappy(t).sort(Order("value", missing=100.0)).limit(3000).hits().select("event_id")


def _vector_rows(t: Tables) -> Search:
    # the vector as a field with several numbers
    df = t.embeddings.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double")))
    return Search(df, DocSchema.of(df, id="vec_id"))


@query("sort_mode_min", "SELECT vec_id FROM embeddings ORDER BY list_min(embedding), vec_id LIMIT 40")
def _(t):
    return _vector_rows(t).sort(Order("embedding")).limit(40).hits().select("vec_id")


@query("sort_mode_max", "SELECT vec_id FROM embeddings ORDER BY list_max(embedding) DESC, vec_id LIMIT 40")
def _(t):
    return _vector_rows(t).sort(Order("embedding").desc()).limit(40).hits().select("vec_id")


@query("sort_mode", """SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 6) AS m FROM embeddings
    ORDER BY list_sum(embedding::DOUBLE[]), vec_id LIMIT 40""")
def _(t):
    s = _vector_rows(t).sort(Order("embedding", mode="sum")).limit(40).sort_values()
    return s.select("vec_id", F.round("_sort_0", 6).alias("m"))


@query("sort_mode_median", """SELECT vec_id, round(list_median(embedding::DOUBLE[]), 6) AS m FROM embeddings
    ORDER BY list_median(embedding::DOUBLE[]), vec_id LIMIT 40""")
def _(t):
    s = _vector_rows(t).sort(Order("embedding", mode="median")).limit(40).sort_values()
    return s.select("vec_id", F.round("_sort_0", 6).alias("m"))


@query("sort_mode_avg", """SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 6) AS m FROM embeddings
    ORDER BY list_avg(embedding::DOUBLE[]) DESC, vec_id LIMIT 40""")
def _(t):
    s = _vector_rows(t).sort(Order("embedding", mode="avg").desc()).limit(40).sort_values()
    return s.select("vec_id", F.round("_sort_0", 6).alias("m"))


@query("sort_unmapped", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 15")
def _(t):
    return orders(t).sort(Order("no_such_field", unmapped="long")).limit(15).hits().select("o_orderkey")


@query("sort_values", """SELECT o_orderkey, o_orderstatus AS _sort_0, o_totalprice AS _sort_1 FROM orders
    ORDER BY o_orderstatus DESC, o_totalprice, o_orderkey LIMIT 10""")
def _(t):
    s = orders(t).sort(Order("o_orderstatus").desc(), Order("o_totalprice"))
    return s.sort_values().select("o_orderkey", "_sort_0", "_sort_1")


# --- pages ---------------------------------------------------------------------------------------------


@query("page", "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 75")
def _(t):
    return orders(t).sort(Order("o_orderdate")).page(3, 25).hits().select("o_orderkey")


@query("page_unpaged", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10000")
def _(t):
    return orders(t).unpaged(10_000).hits().select("o_orderkey")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t):
    return orders(t).sort(Order("o_totalprice").desc()).limit(100).hits().select("o_orderkey", "o_totalprice")


@query("search_after", """SELECT o_orderkey FROM orders WHERE (o_orderstatus < 'O')
    OR (o_orderstatus = 'O' AND (o_totalprice > 150000 OR (o_totalprice = 150000 AND o_orderkey > 100)))
    ORDER BY o_orderstatus DESC, o_totalprice, o_orderkey LIMIT 30""")
def _(t):
    s = orders(t).sort(Order("o_orderstatus").desc(), Order("o_totalprice"), Order("o_orderkey"))
    return s.search_after("O", 150000.0, 100).limit(30).hits().select("o_orderkey")


@query("search_after_null", f"""SELECT event_id FROM {_GAPPY} WHERE v IS NULL AND event_id > 500
    ORDER BY event_id LIMIT 30""")
def _(t):
    s = _gappy(t).sort(Order("value"), Order("event_id"))
    return s.search_after(None, 500).limit(30).hits().select("event_id")


@query("count", "SELECT count(*) AS total FROM orders WHERE o_totalprice > 100000")
def _(t):
    return orders(t).query(C.gt("o_totalprice", 100000.0)).count()


@query("exists_query", "SELECT count(*) > 0 AS \"exists\" FROM orders WHERE o_totalprice > 499999")
def _(t):
    return orders(t).query(C.gt("o_totalprice", 499999.0)).exists()


@query("track_total_hits", """SELECT least(count(*), 1000) AS total,
    CASE WHEN count(*) > 1000 THEN 'GREATER_THAN_OR_EQUAL_TO' ELSE 'EQUAL_TO' END AS relation
    FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    return orders(t).query(C.is_("o_orderstatus", "F")).total(up_to=1000)


@query("total_exact", "SELECT count(*) AS total, 'EQUAL_TO' AS relation FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return orders(t).query(C.is_("o_orderstatus", "F")).total()


@query("search_one", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice, o_orderkey LIMIT 1")
def _(t):
    return orders(t).query(C.is_("o_orderstatus", "P")).sort(Order("o_totalprice")).one().select("o_orderkey")


@query("page_of", """SELECT o_orderkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS total,
      (SELECT ceil(count(*) / 20.0)::BIGINT FROM orders WHERE o_orderstatus = 'P') AS pages
    FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20 OFFSET 40""")
def _(t):
    p = orders(t).query(C.is_("o_orderstatus", "P")).page(2, 20).page_of()
    return p.select("o_orderkey", F.col("_total").alias("total"), F.col("_pages").alias("pages"))


# --- collapse ---------------------------------------------------------------------------------------------


@query("collapse", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def _(t):
    s = orders(t).sort(Order("o_totalprice").desc()).collapse("o_custkey").limit(50)
    return s.hits().select("o_custkey", "o_orderkey", "o_totalprice")


@query("collapse_search_after", """WITH c AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1)
    SELECT o_custkey FROM c WHERE o_custkey > 700 ORDER BY o_custkey LIMIT 25""")
def _(t):
    s = orders(t).sort(Order("o_custkey")).collapse("o_custkey").search_after(700).limit(25)
    return s.hits().select("o_custkey")


@query("collapse_inner_hits", """SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY r) AS hits FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
    WHERE r <= 3 GROUP BY o_custkey""")
def _(t):
    c = collapse_inner_hits(t.orders, "o_custkey", (F.desc("o_totalprice"), F.asc("o_orderkey")), 3, ["o_orderkey"])
    listed = F.array_join(F.transform("inner_hits", lambda h: h["o_orderkey"].cast("string")), ",")
    return c.select("o_custkey", listed.alias("hits"))


@query("terminate_after", """SELECT least(count(*), 1000) AS looked_at, true AS from_table FROM orders""")
def _(t):
    # any 1000 documents, then the buckets: which ones is open, how many is not
    from docspark.operators import aggs
    buckets = aggs.terms_agg(t.orders.limit(1000), "o_orderstatus")
    all_of = aggs.terms_agg(t.orders, "o_orderstatus").select("key", F.col("doc_count").alias("most"))
    return buckets.join(all_of, "key", "left").agg(
        F.sum("doc_count").alias("looked_at"), F.bool_and(F.col("doc_count") <= F.col("most")).alias("from_table"))
