"""Sources, lifecycle and document writes. Merges return the collection as it is afterwards."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from docspark.operators import writes
from docspark.plans import criteria as C
from docspark.plans.search import Search
from docspark.schema import DocSchema
from docspark.sources import tables
from docspark.sources.collection import Collection

from .predicates import orders
from .registry import Tables, query, scratch

ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("scan_index", f"SELECT {ORD} FROM orders")
def _(t):
    return tables.read_index(t.spark, f"{t.folder}/orders.parquet").select(*ORD.split(", "))


@query("describe_index", """SELECT 'doc_id' AS field, 'numeric' AS role, count(doc_id) AS n FROM documents
    UNION ALL SELECT 'text', 'text', count(text) FROM documents UNION ALL SELECT 'lang', 'keyword', count(lang) FROM documents
    UNION ALL SELECT 'source', 'keyword', count(source) FROM documents UNION ALL SELECT 'n_chars', 'numeric', count(n_chars) FROM documents""")
def _(t):
    docs = t.documents
    return DocSchema.of(docs, text=["text"], id="doc_id").describe(docs).select("field", "role", F.col("documents").alias("n"))


@query("index_lifecycle", """SELECT 'created' AS state, 0::BIGINT AS n UNION ALL SELECT 'filled', count(*) FROM customer
    UNION ALL SELECT 'dropped', count(*) FROM customer""")
def _(t):
    c = Collection(t.spark, scratch(t, "lifecycle"), id="c_custkey")
    c.create(t.customer.schema)
    empty = c.read().agg(F.lit("created").alias("state"), F.count(F.lit(1)).alias("n"))
    c.merge(t.customer, lambda cur, inc: writes.bulk_index(cur, inc, "c_custkey"))
    full = c.read().agg(F.lit("filled").alias("state"), F.count(F.lit(1)).alias("n"))
    pinned = c.open_point_in_time()
    c.delete()
    gone = c.read(pinned).agg(F.lit("dropped" if not c.exists() else "kept").alias("state"), F.count(F.lit(1)).alias("n"))
    return empty.unionByName(full).unionByName(gone)


@query("multi_index", """SELECT 'customer' AS _index, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    WHERE c_acctbal > 5000 UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier WHERE s_acctbal > 5000""")
def _(t):
    both = tables.multi_index({
        "customer": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                      F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")),
        "supplier": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                      F.col("s_acctbal").alias("balance"))})
    return Search(both, DocSchema.of(both)).query(C.gt("balance", 5000.0)).matches().select(
        "_index", "id", "name", "balance", "segment")


@query("missing_index_policy", """SELECT 'orders-a' AS _index, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'orders-b', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    cat = tables.Catalog(t.spark)
    cat.put("orders-a", t.orders.where("o_orderstatus = 'F'")).put("orders-b", t.orders.where("o_orderstatus <> 'F'"))
    found = cat.resolve(["orders-*", "no-such"], ignore_unavailable=True)
    return found.groupBy("_index").agg(F.count(F.lit(1)).alias("n"))


@query("json_documents", """SELECT event_id, (props->>'k')::BIGINT AS k, false AS _malformed FROM events""")
def _(t):
    docs = tables.parse_documents(t.events.select("event_id", "props"), "props", "k long")
    return docs.select("event_id", "k", "_malformed")


@query("json_out", """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS json FROM events""")
def _(t):
    return tables.to_documents(t.events.select("event_id", "event_type")).select("event_id", "json")


# --- by id -----------------------------------------------------------------------------------------


@query("get_by_id", f"SELECT {ORD} FROM orders WHERE o_orderkey = 4711")
def _(t):
    return orders(t).query(C.is_("o_orderkey", 4711)).matches().select(*ORD.split(", "))


@query("multi_get", """SELECT p AS _pos, k::BIGINT AS o_orderkey, o_totalprice, o_orderkey IS NOT NULL AS _found FROM
    (VALUES (0, 99), (1, -5), (2, 7), (3, 14000)) v(p, k) LEFT JOIN orders ON o_orderkey = k""")
def _(t):
    return tables.multi_get(t.orders, [99, -5, 7, 14000], "o_orderkey").select("_pos", "o_orderkey", "o_totalprice", "_found")


@query("ids_query", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 5, 9000, 123456789)")
def _(t):
    return orders(t).query(C.ids("o_orderkey", [1, 5, 9000, 123456789])).matches().select("o_orderkey", "o_totalprice")


# --- bulk ---------------------------------------------------------------------------------------------

# changes: finished orders get a discount, and every one of them is placed again under a negative key
NEW = """inc AS (SELECT * REPLACE (o_totalprice * 0.5 AS o_totalprice) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey) FROM orders WHERE o_orderstatus = 'F')"""


def incoming(t: Tables):
    f = t.orders.where("o_orderstatus = 'F'")
    return f.withColumn("o_totalprice", F.col("o_totalprice") * 0.5).unionByName(
        f.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


@query("bulk_index", f"""WITH {NEW} SELECT o_orderkey, o_totalprice FROM inc
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)""")
def _(t):
    return writes.bulk_index(t.orders, incoming(t), "o_orderkey").result.select("o_orderkey", "o_totalprice")


@query("bulk_create", f"""WITH {NEW} SELECT o_orderkey, 'accepted' AS state FROM inc WHERE o_orderkey < 0
    UNION ALL SELECT o_orderkey, 'document already exists' FROM inc WHERE o_orderkey >= 0""")
def _(t):
    r = writes.bulk_create(t.orders, incoming(t), "o_orderkey")
    return r.accepted.select("o_orderkey", F.lit("accepted").alias("state")).unionByName(
        r.rejected.select("o_orderkey", F.col("_reason").alias("state")))


@query("bulk_create_result", f"""WITH {NEW} SELECT o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice FROM inc WHERE o_orderkey < 0""")
def _(t):
    return writes.bulk_create(t.orders, incoming(t), "o_orderkey").result.select("o_orderkey", "o_totalprice")


# stored version 3; events of a user are writes to the order of the same key, their hour is the version
VER = """cur AS (SELECT o_orderkey AS id, o_totalprice AS v, 300 AS ver FROM orders),
    inc AS (SELECT user_id AS id, value AS v, (epoch(ts)::BIGINT // 3600 - 473352) AS ver, event_id AS seq FROM events)"""


def versioned(t: Tables):
    cur = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"), F.lit(300).cast("long").alias("ver"))
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600000000) - 473352
    inc = t.events.select(F.col("user_id").alias("id"), F.col("value").alias("v"), hour.alias("ver"), F.col("event_id").alias("seq"))
    return cur, inc


def _ver_sql(tie):
    return f"""WITH {VER}, u AS (SELECT id, v, ver, 0 AS new, 0 AS seq FROM cur UNION ALL SELECT id, v, ver, 1, seq FROM inc)
    SELECT id, v, ver::BIGINT AS ver FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ver DESC, {tie}) AS r FROM u) WHERE r = 1"""


@query("version_upsert", _ver_sql("new, seq"))
def _(t):
    cur, inc = versioned(t)
    return writes.version_upsert(cur, inc, "id", "ver", order="seq").result


@query("version_upsert_gte", _ver_sql("new DESC, seq DESC"))
def _(t):
    cur, inc = versioned(t)
    return writes.version_upsert(cur, inc, "id", "ver", order="seq", or_equal=True).result


@query("version_conflicts", f"""WITH {VER} SELECT seq FROM (SELECT inc.seq, inc.ver, cur.ver AS stored, max(inc.ver)
    OVER (PARTITION BY id ORDER BY inc.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM inc LEFT JOIN cur USING (id))
    WHERE ver <= greatest(stored, best)""")
def _(t):
    cur, inc = versioned(t)
    return writes.version_upsert(cur, inc, "id", "ver", order="seq").rejected.select("seq")


SEQ = """cur AS (SELECT o_orderkey, o_totalprice, o_custkey % 3 AS seq_no, 1 AS term FROM orders),
    inc AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, length(o_orderpriority) % 3 AS seq_no, 1 AS term FROM orders
      WHERE o_orderstatus <> 'P')"""


@query("seqno_conflict", f"""WITH {SEQ}, m AS (SELECT inc.o_orderkey, inc.seq_no, cur.seq_no AS held FROM inc JOIN cur USING (o_orderkey))
    SELECT o_orderkey, CASE WHEN seq_no = held THEN 'accepted' ELSE 'sequence number conflict' END AS state FROM m""")
def _(t):
    cur = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 3).alias("seq_no"), F.lit(1).alias("term"))
    inc = t.orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        (F.length("o_orderpriority") % 3).cast("long").alias("seq_no"), F.lit(1).alias("term"))
    r = writes.seqno_conflict(cur, inc, "o_orderkey", "seq_no", "term")
    return r.accepted.select("o_orderkey", F.lit("accepted").alias("state")).unionByName(
        r.rejected.select("o_orderkey", F.col("_reason").alias("state")))


# --- updates --------------------------------------------------------------------------------------------

# the customers of the first region move into one segment; some patches have no balance
PATCH = """p AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal + 10 END AS c_acctbal, 'MOVED' AS c_mktsegment
      FROM customer WHERE c_nationkey < 5 UNION ALL SELECT -1 - c_custkey, 1.0, 'NEW' FROM customer WHERE c_nationkey = 6)"""


def patches(t: Tables):
    a = t.customer.where("c_nationkey < 5").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") + 10).alias("c_acctbal"), F.lit("MOVED").alias("c_mktsegment"))
    b = t.customer.where("c_nationkey = 6").select(
        (-1 - F.col("c_custkey")).alias("c_custkey"), F.lit(1.0).alias("c_acctbal"), F.lit("NEW").alias("c_mktsegment"))
    return a.unionByName(b)


FIELDS = ["c_acctbal", "c_mktsegment"]
COLS = ["c_custkey", "c_name", *FIELDS]


@query("partial_update", f"""WITH {PATCH} SELECT c.c_custkey, c_name, coalesce(p.c_acctbal, c.c_acctbal) AS c_acctbal,
    coalesce(p.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN p USING (c_custkey)""")
def _(t):
    return writes.partial_update(t.customer, patches(t), "c_custkey", FIELDS).result.select(*COLS)


@query("partial_update_missing", f"WITH {PATCH} SELECT c_custkey, 'document missing' AS _reason FROM p WHERE c_custkey < 0")
def _(t):
    return writes.partial_update(t.customer, patches(t), "c_custkey", FIELDS).rejected.select("c_custkey", "_reason")


@query("upsert_doc", f"""WITH {PATCH} SELECT coalesce(c.c_custkey, p.c_custkey) AS c_custkey,
    CASE WHEN c.c_custkey IS NULL THEN 'unknown' ELSE c_name END AS c_name, coalesce(p.c_acctbal, c.c_acctbal) AS c_acctbal,
    coalesce(p.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c FULL JOIN p ON c.c_custkey = p.c_custkey""")
def _(t):
    r = writes.upsert_doc(t.customer, patches(t), "c_custkey", FIELDS, insert={"c_name": F.lit("unknown")})
    return r.result.select(*COLS)


@query("script_update", """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
    THEN c_acctbal * 2 + 1 ELSE c_acctbal END AS c_acctbal FROM customer""")
def _(t):
    big = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return writes.script_update(t.customer, "c_custkey", big, {"c_acctbal": "c_acctbal * 2 + 1"}).result.select("c_custkey", "c_acctbal")


@query("update_by_query", """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    return writes.update_by_query(t.orders, F.col("o_totalprice") < 50000, {"o_orderstatus": F.lit("X")}).result.select(
        "o_orderkey", "o_orderstatus")


@query("update_by_query_max", """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 50000
    ORDER BY o_orderdate, o_orderkey LIMIT 500) THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    r = writes.update_by_query(t.orders, F.col("o_totalprice") < 50000, {"o_orderstatus": F.lit("X")},
                               id="o_orderkey", max_docs=500, order=[F.asc("o_orderdate")])
    return r.result.select("o_orderkey", "o_orderstatus")


@query("update_by_query_counts", "SELECT count(*) AS total, least(count(*), 500) AS changed FROM orders WHERE o_totalprice < 50000")
def _(t):
    return writes.by_query_counts(t.orders, F.col("o_totalprice") < 50000, 500)


@query("delete_by_query", "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)")
def _(t):
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return writes.delete_by_query(t.orders, gone).result.select("o_orderkey")


@query("delete_by_query_max", """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders
    WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 300)""")
def _(t):
    r = writes.delete_by_query(t.orders, F.col("o_orderstatus") == "F", id="o_orderkey", max_docs=300, order=[F.desc("o_totalprice")])
    return r.result.select("o_orderkey")


@query("delete_by_ids", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(t):
    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return writes.delete_by_ids(t.orders, ids, "o_orderkey").result.select("o_orderkey")


# --- copies -----------------------------------------------------------------------------------------------


@query("reindex", """SELECT doc_id, upper(lang) AS language, length(text) AS size FROM documents WHERE n_chars > 100
    UNION ALL SELECT doc_id, 'old', -1 FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 100)""")
def _(t):
    target = t.labels.select("doc_id", F.lit("old").alias("language"), F.lit(-1).cast("long").alias("size"))
    job = writes.Reindex(predicate=F.col("n_chars") > 100, script={"language": "upper(lang)", "size": "cast(length(text) as long)"},
                         includes=["doc_id", "language", "size"])
    return job.into(t.documents, target, "doc_id").result


@query("reindex_counts", """SELECT count(*) AS total, count(*) FILTER (l.doc_id IS NULL) AS created, count(l.doc_id) AS updated
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE n_chars > 100""")
def _(t):
    return writes.Reindex(predicate=F.col("n_chars") > 100).counts(t.documents, t.labels, "doc_id")


@query("reindex_create", """SELECT doc_id, source FROM (SELECT doc_id, NULL AS source FROM labels UNION ALL
    SELECT doc_id, source FROM (SELECT * FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 400)
    WHERE doc_id NOT IN (SELECT doc_id FROM labels))""")
def _(t):
    target = t.labels.select("doc_id", F.lit(None).cast("string").alias("source"))
    job = writes.Reindex(predicate=F.col("lang") == "en", max_docs=400, op_type="create", includes=["doc_id", "source"])
    return job.into(t.documents, target, "doc_id").result


@query("reindex_rename", "SELECT doc_id, text AS message FROM documents WHERE lang = 'de'")
def _(t):
    job = writes.Reindex(predicate=F.col("lang") == "de", rename={"text": "message"}, excludes=["lang", "source", "n_chars"])
    return job.documents(t.documents, "doc_id")


@query("slice", "SELECT count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents")
def _(t):
    # the slices together hold every document once
    parts = None
    for i in range(4):
        p = t.documents.where(writes.in_slice(F.col("doc_id"), i, 4)).select("doc_id")
        parts = p if parts is None else parts.unionByName(p)
    return parts.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"))


@query("routing_partition", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42")
def _(t):
    c = Collection(t.spark, scratch(t, "routing"), id="o_orderkey", routing="o_custkey", buckets=8)
    c.commit(t.orders)
    return c.read_route(42).select("o_orderkey", "o_totalprice")


@query("index_sort", "SELECT l_linestatus, count(*) AS n, 0::BIGINT AS inversions FROM lineitem GROUP BY 1")
def _(t):
    path = scratch(t, "sorted")
    tables.write_sorted(t.lineitem.select("l_orderkey", "l_shipdate", "l_linestatus"), path,
                        [F.desc("l_shipdate"), F.asc_nulls_last("l_orderkey")], partition_by=["l_linestatus"])
    # neighbours of a file in the wrong order: none, if the order is stored
    read = t.spark.read.parquet(path).withColumns({"file": F.input_file_name(), "place": F.monotonically_increasing_id()})
    of_file = Window.partitionBy("file").orderBy("place")
    before = read.withColumns({"day": F.lag("l_shipdate").over(of_file), "key": F.lag("l_orderkey").over(of_file)})
    wrong = (F.col("day") < F.col("l_shipdate")) | ((F.col("day") == F.col("l_shipdate")) & (F.col("key") > F.col("l_orderkey")))
    return before.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("inversions"))


@query("point_in_time", "SELECT 'old' AS view, count(*) AS n FROM orders UNION ALL SELECT 'new', count(*) FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    c = Collection(t.spark, scratch(t, "pit"), id="o_orderkey", buckets=8)
    c.commit(t.orders)
    pinned = c.open_point_in_time()
    c.commit(writes.delete_by_query(c.read(), F.col("o_orderstatus") == "F").result)
    old = c.read(pinned).agg(F.lit("old").alias("view"), F.count(F.lit(1)).alias("n"))
    return old.unionByName(c.read().agg(F.lit("new").alias("view"), F.count(F.lit(1)).alias("n")))


@query("alias_view", """SELECT 'orders' AS _index, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    cat = tables.Catalog(t.spark).put("orders", t.orders)
    cat.add_alias("urgent_orders", "orders", F.col("o_orderpriority") == "1-URGENT")
    return t.spark.sql("SELECT _index, o_orderkey FROM urgent_orders")


@query("audit_columns", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '2024-05-06 07:08:09' END AS created_at,
    CASE WHEN o_orderstatus = 'F' THEN 'loader' ELSE 'me' END AS created_by, TIMESTAMP '2024-05-06 07:08:09' AS modified_at FROM orders""")
def _(t):
    stamp = t.orders.schema["o_orderdate"].dataType
    stored = t.orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", F.col("o_orderdate").alias("created_at"), F.lit("loader").alias("created_by"))
    now = F.lit(dt.datetime(2024, 5, 6, 7, 8, 9).isoformat(sep=" ")).cast(stamp)
    out = writes.audit(t.orders, stored, "o_orderkey", now, "me")
    return out.select("o_orderkey", "created_at", "created_by", "modified_at")


@query("row_hooks", """SELECT c_custkey, lower(c_name) || '!' AS c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_acctbal > 0""")
def _(t):
    hooks = (writes.RowHooks()
             .add("before_save", lambda d: d.withColumn("c_name", F.concat("c_name", F.lit("!"))), order=2)
             .add("before_save", lambda d: d.withColumn("c_name", F.lower("c_name")), order=1)
             .add("after_load", lambda d: d.where("c_acctbal > 0"))
             .add("after_convert", lambda d: d.withColumn("c_acctbal", F.col("c_acctbal") + 1)))
    df = t.customer
    for stage in ("before_convert", "before_save", "after_load", "after_convert"):
        df = hooks.run(stage, df)
    return df.select("c_custkey", "c_name", "c_acctbal")


@query("scroll", """SELECT o_orderkey, b AS _batch FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS b
    FROM orders WHERE o_orderstatus = 'O') WHERE b < 8""")
def _(t):
    # eight batches of 500 hits
    return orders(t).query(C.is_("o_orderstatus", "O")).batches(500, max_results=4000).select("o_orderkey", "_batch")


@query("scroll_string_ids", """SELECT id, (row_number() OVER (ORDER BY id) - 1) // 500 AS _batch
    FROM (SELECT o_orderstatus || '-' || o_orderkey AS id FROM orders)""")
def _(t):
    df = t.orders.select(F.concat_ws("-", "o_orderstatus", F.col("o_orderkey").cast("string")).alias("id"))
    return Search(df, DocSchema.of(df, id="id")).batches(500).select("id", "_batch")


@query("alias_and_index", """SELECT 'all' AS named, count(*) AS n FROM orders UNION ALL
    SELECT 'two', count(*) FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000""")
def _(t):
    catalog = tables.Catalog(t.spark).put("orders", t.orders)
    catalog.add_alias("finished", "orders", F.col("o_orderstatus") == "F")
    catalog.add_alias("large", "orders", F.col("o_totalprice") > 200000)
    seen = [("all", ["finished", "orders"]), ("two", ["finished", "large"])]
    counts = [catalog.resolve(names).agg(F.lit(n).alias("named"), F.count(F.lit(1)).alias("n")) for n, names in seen]
    return counts[0].unionByName(counts[1])


@query("stream_results", """SELECT b AS _batch, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM
    (SELECT o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS b FROM orders WHERE o_totalprice > 100000) GROUP BY 1""")
def _(t):
    hits = orders(t).query(C.gt("o_totalprice", 100000.0)).batches(500)
    return hits.groupBy("_batch").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
