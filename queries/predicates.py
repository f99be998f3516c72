"""Predicates and their composition."""

import datetime as dt

from pyspark.sql import functions as F

from docspark.functions import convert
from docspark.operators import aggs, byexample, proximity, scoring
from docspark.plans import criteria as C
from docspark.plans.search import Search
from docspark.schema import DocSchema, FieldSpec

from .registry import Tables, padded, query, tok

# what the text queries ask for
PHRASE = "of the"


def orders(t: Tables) -> Search:
    df = t.orders
    return Search(df, DocSchema.of(df, id="o_orderkey"))


def parts(t: Tables, text=()) -> Search:
    df = t.part
    return Search(df, DocSchema.of(df, text=text, id="p_partkey"))


def documents(t: Tables) -> Search:
    df = t.documents
    return Search(df, DocSchema.of(df, text=["text"], id="doc_id"))


def ids(s: Search, node, *columns):
    return s.query(node).matches().select(*columns)


# --- equality and presence -------------------------------------------------------------------


@query("is", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def _(t):
    return ids(orders(t), C.is_("o_orderstatus", "O"), "o_orderkey", "o_orderstatus")


@query("is_text", f"""SELECT doc_id, lang FROM documents
    WHERE list_contains({tok('text')}, 'the') AND list_contains({tok('text')}, 'rewh')""")
def _(t):
    return ids(documents(t), C.is_("text", "The REWH"), "doc_id", "lang")


def _events(t: Tables) -> Search:
    df = t.events.withColumn("value", F.when(F.col("value") >= 10, F.col("value")))
    return Search(df, DocSchema.of(df, id="event_id"))


@query("exists", "SELECT event_id FROM events WHERE value >= 10")
def _(t):
    return ids(_events(t), C.exists("value"), "event_id")


@query("is_null", "SELECT event_id FROM events WHERE NOT coalesce(value >= 10, false)")
def _(t):
    return ids(_events(t), C.is_null("value"), "event_id")


def _pages(t: Tables) -> Search:
    # the query string of a page address: empty where there is none
    df = t.pages.select("page_id", F.regexp_extract("url", r"\?(.*)$", 1).alias("params"))
    return Search(df, DocSchema.of(df, id="page_id"))


@query("empty", "SELECT page_id FROM pages WHERE regexp_extract(url, '\\?(.*)$', 1) = ''")
def _(t):
    return ids(_pages(t), C.empty("params"), "page_id")


@query("not_empty", "SELECT page_id FROM pages WHERE regexp_extract(url, '\\?(.*)$', 1) <> ''")
def _(t):
    return ids(_pages(t), C.not_empty("params"), "page_id")


# --- pieces of a value -------------------------------------------------------------------------


@query("starts_with", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'sma%'")
def _(t):
    return ids(parts(t), C.starts_with("p_name", "sma"), "p_partkey", "p_name")


@query("like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def _(t):
    return ids(parts(t), C.like("p_name", "red"), "p_partkey", "p_name")


@query("ends_with", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'")
def _(t):
    return ids(parts(t), C.ends_with("p_name", "bolt"), "p_partkey", "p_name")


@query("contains", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%idg%'")
def _(t):
    return ids(parts(t), C.contains("p_name", "idg"), "p_partkey", "p_name")


@query("starts_with_text", f"""SELECT p_partkey FROM part
    WHERE len(list_filter({tok('p_name')}, lambda x: starts_with(x, 'gi'))) > 0""")
def _(t):
    return ids(parts(t, ["p_name"]), C.starts_with("p_name", "GI"), "p_partkey")


@query("contains_text", f"""SELECT doc_id FROM documents
    WHERE len(list_filter({tok('text')}, lambda x: contains(x, 'ehel'))) > 0""")
def _(t):
    return ids(documents(t), C.contains("text", "ehel"), "doc_id")


@query("ends_with_text", f"""SELECT doc_id FROM documents
    WHERE len(list_filter({tok('text')}, lambda x: ends_with(x, 'ntion'))) > 0""")
def _(t):
    return ids(documents(t), C.ends_with("text", "ntion"), "doc_id")


@query("wildcard", "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#.[0-4]')"
       " OR regexp_full_match(p_name, '.*l. .*')")
def _(t):
    return ids(parts(t), C.regexp("p_brand", "Brand#.[0-4]") | C.wildcard("p_name", "*l? *"),
               "p_partkey", "p_brand")


@query("wildcard_text", f"""SELECT doc_id FROM documents
    WHERE len(list_filter({tok('text')}, lambda x: regexp_full_match(x, 'th.t.*on'))) > 0""")
def _(t):
    return ids(documents(t), C.wildcard("text", "th?t*on"), "doc_id")


@query("regexp", "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[12]')")
def _(t):
    return ids(parts(t), C.regexp("p_brand", "Brand#[12]"), "p_partkey", "p_brand")


@query("expression", f"""SELECT doc_id FROM (SELECT doc_id, {tok('text')} AS w FROM documents)
    WHERE list_contains(w, 'the') AND (list_contains(w, 'rewh') OR list_contains(w, 'ononst'))
    AND NOT list_contains(w, 'der')""")
def _(t):
    return ids(documents(t), C.expression("text", ["the"], ["rewh", "ononst"], ["der"]), "doc_id")


# --- ranges ---------------------------------------------------------------------------------------

_LINE = "l_orderkey, l_linenumber, l_quantity"


def _lines(t: Tables, node):
    df = t.lineitem
    return Search(df, DocSchema.of(df)).query(node).matches().select(*_LINE.split(", "))


@query("lt", f"SELECT {_LINE} FROM lineitem WHERE l_quantity < 3")
def _(t):
    return _lines(t, C.lt("l_quantity", 3.0))


@query("lte", f"SELECT {_LINE} FROM lineitem WHERE l_quantity <= 3")
def _(t):
    return _lines(t, C.lte("l_quantity", 3.0))


@query("gt", f"SELECT {_LINE} FROM lineitem WHERE l_quantity > 48")
def _(t):
    return _lines(t, C.gt("l_quantity", 48.0))


@query("gte", f"SELECT {_LINE} FROM lineitem WHERE l_quantity >= 48")
def _(t):
    return _lines(t, C.gte("l_quantity", 48.0))


@query("between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def _(t):
    return ids(orders(t), C.between("o_totalprice", 1000.0, 50000.0), "o_orderkey", "o_totalprice")


@query("between_open", "SELECT o_orderkey FROM orders WHERE o_totalprice >= 300000")
def _(t):
    return ids(orders(t), C.between("o_totalprice", 300000.0, None), "o_orderkey")


@query("before", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1995-06-30'")
def _(t):
    return ids(orders(t), C.before("o_orderdate", dt.datetime(1995, 6, 30)), "o_orderkey", "o_orderdate")


@query("after", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-03-01'")
def _(t):
    return ids(orders(t), C.after("o_orderdate", dt.datetime(2001, 3, 1)), "o_orderkey", "o_orderdate")


@query("ip_range", """WITH e AS (SELECT event_id, user_id % 256 AS c, event_id % 256 AS d FROM events)
    SELECT event_id FROM e WHERE c BETWEEN 16 AND 31 OR (c = 7 AND d BETWEEN 100 AND 200)""")
def _(t):
    ip = F.concat_ws(".", F.lit("10"), F.lit("1"), F.col("user_id") % 256, F.col("event_id") % 256)
    df = t.events.withColumn("ip", ip)
    return df.where(convert.ip_in_network(F.col("ip"), "10.1.16.0/20")
                    | convert.ip_between(F.col("ip"), "10.1.7.100", "10.1.7.200")).select("event_id")


# an order is open from its date for as many days as its priority says
_OPEN = "o_orderdate AS lo, o_orderdate + to_days(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS hi"


def _open_orders(t: Tables):
    days = F.substring("o_orderpriority", 1, 1).cast("int")
    lo = F.col("o_orderdate")
    hi = (lo + F.make_dt_interval(days)).cast(t.orders.schema["o_orderdate"].dataType)
    return t.orders.withColumn("open", convert.make_range(lo, hi, True, False))


@query("range_field", f"""WITH o AS (SELECT o_orderkey, {_OPEN} FROM orders)
    SELECT o_orderkey, lo <= TIMESTAMP '1998-05-05' AND hi > TIMESTAMP '1998-05-05' AS holds,
      lo >= TIMESTAMP '1998-05-01' AND hi <= TIMESTAMP '1998-05-08' AS inside
    FROM o WHERE lo <= TIMESTAMP '1998-05-07' AND hi > TIMESTAMP '1998-05-01'""")
def _(t):
    df = _open_orders(t)
    dtype = t.orders.schema["o_orderdate"].dataType

    def at(day):
        return F.lit(day).cast(dtype)
    asked = convert.make_range(at("1998-05-01"), at("1998-05-08"), True, False)
    touch = convert.make_range(at("1998-05-01"), at("1998-05-07"), True, True)
    return (df.where(convert.ranges_intersect(F.col("open"), touch))
            .select("o_orderkey", convert.range_contains(F.col("open"), at("1998-05-05")).alias("holds"),
                    convert.range_within(F.col("open"), asked).alias("inside")))


@query("range_overlaps", f"""WITH o AS (SELECT o_orderkey, epoch_us(lo) AS lo, epoch_us(hi) AS hi
      FROM (SELECT o_orderkey, {_OPEN} FROM orders)),
    b AS (SELECT list_sort(list(lo)) AS los, list_sort(list(hi)) AS his FROM o),
    s AS (SELECT x, count(*) AS n FROM (SELECT unnest(los) AS x FROM b) GROUP BY x),
    e AS (SELECT x, count(*) AS n FROM (SELECT unnest(his) AS x FROM b) GROUP BY x),
    sc AS (SELECT x, sum(n) OVER (ORDER BY x) AS c FROM s),
    ec AS (SELECT x, sum(n) OVER (ORDER BY x) AS c FROM e)
    SELECT o.o_orderkey, CAST(st.c - coalesce(en.c, 0) AS BIGINT) AS overlaps
    FROM o ASOF JOIN sc st ON o.hi > st.x ASOF LEFT JOIN ec en ON o.lo >= en.x""")
def _(t):
    df = _open_orders(t).select(
        "o_orderkey", F.unix_micros(F.col("open.lo").cast("timestamp")).alias("lo"),
        F.unix_micros(F.col("open.hi").cast("timestamp")).alias("hi"))
    return proximity.count_overlaps(df, df.select(F.col("lo").alias("a"), F.col("hi").alias("b")),
                                    left_range=("lo", "hi"), right_range=("a", "b"), left_id="o_orderkey",
                                    left_open=True, right_open=True)


@query("range_pairs", f"""WITH o AS (SELECT o_orderkey, {_OPEN} FROM orders),
      c AS (SELECT n_nationkey, TIMESTAMP '1992-01-01' + to_days(CAST(n_nationkey * 100 AS INTEGER)) AS clo,
        CASE WHEN n_nationkey < 24 THEN TIMESTAMP '1992-01-01' + to_days(CAST(n_nationkey * 100 + 30 AS INTEGER)) END AS chi FROM nation)
    SELECT n_nationkey, count(*) AS touching, count(*) FILTER (WHERE clo <= lo AND (chi IS NULL OR hi <= chi)) AS inside
    FROM o JOIN c ON lo < coalesce(chi, TIMESTAMP '9999-01-01') AND clo < hi GROUP BY n_nationkey""")
def _(t):
    # orders that are open during campaigns; the last campaign has no end
    day = F.lit("1992-01-01").cast("date")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    opened = _open_orders(t).select("o_orderkey", micros(F.col("open.lo")).alias("lo"), micros(F.col("open.hi")).alias("hi"))
    start = F.date_add(day, (F.col("n_nationkey") * 100).cast("int"))
    campaigns = t.nation.select("n_nationkey", micros(start).alias("clo"), F.when(
        F.col("n_nationkey") < 24, micros(F.date_add(start, 30))).alias("chi"))
    pairs = proximity.range_pairs(opened, campaigns, left_range=("lo", "hi"), right_range=("clo", "chi"),
                                  width=30 * 86400e6, half_open=True)
    inside = (F.col("clo") <= F.col("lo")) & (F.col("chi").isNull() | (F.col("hi") <= F.col("chi")))
    return pairs.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("touching"), F.count_if(inside).alias("inside"))


# --- lists -----------------------------------------------------------------------------------------


@query("in", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return ids(orders(t), C.in_("o_orderpriority", ["1-URGENT", None, "2-HIGH"]), "o_orderkey")


@query("in_text", f"""SELECT doc_id FROM documents
    WHERE contains({padded('text')}, ' of the ') OR contains({padded('text')}, ' de la ')""")
def _(t):
    return ids(documents(t), C.in_("text", ["of the", "De la"]), "doc_id")


@query("not_in", "SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"
       " OR o_orderpriority IS NULL")
def _(t):
    return ids(orders(t), C.not_in("o_orderpriority", ["1-URGENT", "2-HIGH"]), "o_orderkey")


@query("terms_lookup", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5 AND p_type = 'ECONOMY')""")
def _(t):
    wanted = t.part.where("p_size < 5 AND p_type = 'ECONOMY'").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.join(wanted, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


# --- text -------------------------------------------------------------------------------------------


@query("matches", f"""SELECT doc_id FROM documents
    WHERE list_has_any({tok('text')}, ['rewh', 'hehely', 'unknownword'])""")
def _(t):
    return ids(documents(t), C.matches("text", "rewh, hehely unknownword"), "doc_id")


@query("matches_all", f"""SELECT doc_id FROM documents
    WHERE list_has_all({tok('text')}, ['orre', 'thatin'])""")
def _(t):
    return ids(documents(t), C.matches_all("text", "orre thatin"), "doc_id")


@query("phrase", f"SELECT doc_id FROM documents WHERE contains({padded('text')}, ' {PHRASE} ')")
def _(t):
    return ids(documents(t), C.phrase("text", PHRASE), "doc_id")


@query("phrase_conversations", f"""SELECT conv_id, turn FROM conversations
    WHERE contains({padded('text')}, ' in the ') AND role = 'user'""")
def _(t):
    df = t.conversations
    s = Search(df, DocSchema.of(df, text=["text"]))
    return ids(s, C.phrase("text", "in the") & C.is_("role", "user"), "conv_id", "turn")


def _near(word: str, edits: int, variants: list[str]) -> str:
    swapped = " OR ".join(f"levenshtein(x, '{v}') <= {edits - 1}" for v in variants)
    return f"(abs(len(x) - {len(word)}) <= {edits} AND (levenshtein(x, '{word}') <= {edits} OR {swapped}))"


@query("fuzzy", f"""SELECT doc_id FROM documents WHERE len(list_filter({tok('text')},
    lambda x: {_near('orre', 1, ['rore', 'orer'])})) > 0""")
def _(t):
    return ids(documents(t), C.fuzzy("text", "orre"), "doc_id")


@query("fuzzy_two", f"""SELECT doc_id FROM documents WHERE len(list_filter({tok('text')},
    lambda x: {_near('thatin', 2, ['htatin', 'tahtin', 'thtain', 'thaitn', 'thatni'])}
      OR x IN ('htaitn', 'httain', 'htatni', 'tahitn', 'tahtni', 'thtani', 'thitan'))) > 0""")
def _(t):
    return ids(documents(t), C.fuzzy("text", "thatin"), "doc_id")


@query("term", f"SELECT doc_id FROM documents WHERE list_contains({tok('text')}, 'hehely')")
def _(t):
    return ids(documents(t), C.term("text", "hehely"), "doc_id")


# --- composition ---------------------------------------------------------------------------------------


@query("match_all", "SELECT o_orderkey, 1.0::DOUBLE AS _score FROM orders")
def _(t):
    return orders(t).query(C.MatchAll()).with_scores().matches().select("o_orderkey", "_score")


@query("bool", """SELECT o_orderkey FROM orders WHERE o_totalprice > 100000
    AND o_orderdate >= TIMESTAMP '1997-01-01' AND NOT (o_orderpriority = '5-LOW')""")
def _(t):
    node = C.Bool(must=(C.gt("o_totalprice", 100000.0),),
                  should=(C.is_("o_orderstatus", "O"),),
                  must_not=(C.is_("o_orderpriority", "5-LOW"),),
                  filter=(C.gte("o_orderdate", dt.datetime(1997, 1, 1)),))
    return ids(orders(t), node, "o_orderkey")


@query("bool_should", """SELECT o_orderkey FROM orders
    WHERE o_orderstatus = 'P' OR o_totalprice < 10000""")
def _(t):
    node = C.Criteria.where("o_orderstatus").is_("P").or_("o_totalprice").lt(10000.0)
    return ids(orders(t), node, "o_orderkey")


@query("bool_chain", """SELECT o_orderkey, (2.0 + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::DOUBLE
      AS _score FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 200000""")
def _(t):
    node = (C.Criteria.where("o_orderstatus").is_("O").and_("o_totalprice").gte(200000.0)
            .or_("o_orderpriority").is_("1-URGENT"))
    return orders(t).query(node).with_scores().matches().select("o_orderkey", "_score")


@query("bool_negated_first", """SELECT o_orderkey FROM orders
    WHERE NOT (o_orderstatus = 'F') OR o_totalprice > 300000""")
def _(t):
    node = C.Criteria.where("o_orderstatus").not_().is_("F").or_("o_totalprice").gt(300000.0)
    return ids(orders(t), node, "o_orderkey")


@query("must", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def _(t):
    return ids(orders(t), C.is_("o_orderstatus", "F") & C.is_("o_orderpriority", "2-HIGH"), "o_orderkey")


@query("should", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '2-HIGH'")
def _(t):
    return ids(orders(t), C.is_("o_orderstatus", "F") | C.is_("o_orderpriority", "2-HIGH"), "o_orderkey")


@query("must_not", "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' OR o_orderpriority = '2-HIGH')")
def _(t):
    return ids(orders(t), ~(C.is_("o_orderstatus", "F") | C.is_("o_orderpriority", "2-HIGH")), "o_orderkey")


@query("sub_criteria", """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'
    AND (o_orderpriority = '1-URGENT' OR o_totalprice > 350000)""")
def _(t):
    inner = C.Criteria.where("o_orderpriority").is_("1-URGENT").or_("o_totalprice").gt(350000.0)
    return ids(orders(t), C.Criteria.where("o_orderstatus").is_("O").sub(inner), "o_orderkey")


@query("criteria_same_field", "SELECT p_partkey FROM part WHERE p_name LIKE 'b%' AND p_name LIKE '%t'")
def _(t):
    return ids(parts(t), C.Criteria.where("p_name").starts_with("b").ends_with("t"), "p_partkey")


@query("boost", """SELECT o_orderkey, (CASE WHEN o_orderstatus = 'P' THEN 2.5 ELSE 0 END
      + CASE WHEN o_orderpriority = '5-LOW' THEN 0.5 ELSE 0 END)::DOUBLE AS _score
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""")
def _(t):
    node = C.is_("o_orderstatus", "P").boost(2.5) | C.is_("o_orderpriority", "5-LOW").boost(0.5)
    return orders(t).query(node).with_scores().matches().select("o_orderkey", "_score")


@query("post_filter", """WITH q AS (SELECT * FROM orders WHERE o_totalprice > 200000),
    a AS (SELECT o_orderstatus, count(*) AS n FROM q GROUP BY 1),
    h AS (SELECT o_orderstatus, count(*) AS hits FROM q WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT a.o_orderstatus, n, hits FROM a JOIN h USING (o_orderstatus)""")
def _(t):
    s = orders(t).query(C.gt("o_totalprice", 200000.0)).post_filter(C.is_("o_orderpriority", "1-URGENT"))
    # buckets count all matches, hits only what passes the post filter
    buckets = aggs.terms_agg(s.matches(), "o_orderstatus").select(
        F.col("key").alias("o_orderstatus"), F.col("doc_count").alias("n"))
    hits = s.unpaged(None)._filtered().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("hits"))
    return buckets.join(hits, "o_orderstatus")


@query("match_examples", """SELECT c_custkey, c_name FROM customer
    WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7 AND c_name LIKE 'Customer#%'""")
def _(t):
    df = t.customer
    schema = DocSchema.of(df, id="c_custkey")
    probe = {"c_mktsegment": "BUILDING", "c_nationkey": 7, "c_name": "Customer#", "c_acctbal": None}
    node = byexample.example_criteria(probe, schema, matchers={"c_name": "starting"})
    return ids(Search(df, schema), node, "c_custkey", "c_name")


@query("match_examples_any", """SELECT c_custkey FROM customer
    WHERE c_mktsegment = 'BUILDING' OR c_nationkey = 7""")
def _(t):
    df = t.customer
    schema = DocSchema.of(df, id="c_custkey")
    node = byexample.example_criteria({"c_mktsegment": "BUILDING", "c_nationkey": 7}, schema, match="any")
    return ids(Search(df, schema), node, "c_custkey")


@query("match_examples_batch", """WITH p AS (SELECT n_nationkey AS probe,
      CASE WHEN n_regionkey <> 0 THEN n_nationkey END AS nat,
      CASE WHEN n_regionkey < 3 THEN ['AUTOMOBILE', 'BUILDING', 'FURNITURE'][n_regionkey + 1] END AS seg
      FROM nation)
    SELECT probe, count(*) AS n FROM p JOIN customer ON (nat IS NULL OR c_nationkey = nat)
      AND (seg IS NULL OR c_mktsegment = seg) GROUP BY probe""")
def _(t):
    region = F.col("n_regionkey")
    probes = t.nation.select(
        F.col("n_nationkey").alias("probe"), F.when(region != 0, F.col("n_nationkey")).alias("c_nationkey"),
        F.when(region == 0, "AUTOMOBILE").when(region == 1, "BUILDING").when(region == 2, "FURNITURE")
        .alias("c_mktsegment"))
    # equal customers are counted first, so a pair is one row per combination
    groups = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("c"))
    pairs = byexample.match_examples(groups, probes, ["c_nationkey", "c_mktsegment"], probe_id="probe")
    return pairs.groupBy("probe").agg(F.sum("c").alias("n"))


@query("named_queries", """SELECT o_orderkey, o_totalprice > 200000 AS high,
      o_orderpriority = '1-URGENT' AS urgent FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    s = orders(t)
    hits = s.query(C.is_("o_orderstatus", "F")).matches()
    named = scoring.matched_queries(hits, s.schema, {"high": C.gt("o_totalprice", 200000.0),
                                                     "urgent": C.is_("o_orderpriority", "1-URGENT")})
    return named.select("o_orderkey", F.map_contains_key("matched_queries", "high").alias("high"),
                        F.map_contains_key("matched_queries", "urgent").alias("urgent"))


@query("value_converter", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P')")
def _(t):
    names = {"open": "O", "pending": "P", "finished": "F"}
    df = t.orders
    schema = DocSchema.of(df, id="o_orderkey", overrides=[
        FieldSpec("status", "keyword", "o_orderstatus", convert=names.__getitem__)])
    return ids(Search(df, schema), C.in_("status", ["open", "pending"]), "o_orderkey")
