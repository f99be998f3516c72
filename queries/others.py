"""Suggestions, conversions, SQL and streams."""

import os

from pyspark.sql import functions as F

from docspark.functions import convert
from docspark.operators import suggest, writes
from docspark.plans import criteria as C
from docspark.plans.search import Search
from docspark.schema import DocSchema
from docspark.sources import sql as S
from docspark.sources.collection import Collection
from docspark.sources.completion import CompletionIndex
from docspark.streaming import streams

from .registry import query, scratch, state, text_index, tok

# --- suggestions ------------------------------------------------------------------------------------

VOCAB = f"vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({tok('text')}) AS term FROM documents) GROUP BY 1)"


@query("suggest_term", f"""WITH {VOCAB}, q AS (SELECT unnest(['thatim', 'helely', 'orreh']) AS token, unnest([0, 1, 2]) AS position),
    c AS (SELECT position, token, term, df, 1 - levenshtein(term, token) / least(length(term), length(token))::DOUBLE AS score
      FROM q JOIN vocab ON left(term, 1) = left(token, 1) WHERE length(term) >= 4 AND levenshtein(term, token) <= 2
      AND term <> token AND token NOT IN (SELECT term FROM vocab)),
    r AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY score DESC, df DESC, term) AS rank FROM c)
    SELECT position, token, term, df, round(score, 6) AS score FROM r WHERE rank <= 5""")
def _(t):
    s = suggest.suggest_term(t.documents, "doc_id", "text", "thatim helely orreh", vocab=text_index(t).terms())
    return s.select("position", "token", "term", "df", F.round("score", 6).alias("score"))


@query("suggest_term_popular", f"""WITH {VOCAB}, q AS (SELECT 0 AS position, 'thatio' AS token),
    c AS (SELECT position, token, term, df, 1 - levenshtein(term, token) / least(length(term), length(token))::DOUBLE AS score
      FROM q JOIN vocab ON left(term, 1) = left(token, 1) WHERE length(term) >= 4 AND levenshtein(term, token) <= 2
      AND term <> token AND df > coalesce((SELECT df FROM vocab v WHERE v.term = 'thatio'), 0))
    SELECT token, term, df FROM c ORDER BY df DESC, score DESC, term LIMIT 4""")
def _(t):
    s = suggest.suggest_term(t.documents, "doc_id", "text", "thatio", mode="popular", sort="frequency", size=4,
                             vocab=text_index(t).terms())
    return s.select("token", "term", "df")


_WORDS = ["thatim", "orreh", "the"]


@query("suggest_phrase", f"""WITH {VOCAB.replace("count(DISTINCT doc_id) AS df", "count(DISTINCT doc_id) AS df, count(*) AS freq")},
    st AS (SELECT count(*) AS v, sum(freq)::DOUBLE AS f FROM vocab),
    q AS (SELECT unnest({_WORDS}) AS token, unnest([0, 1, 2]) AS position),
    c AS (SELECT position, term, df, CASE WHEN token IN (SELECT term FROM vocab) THEN ln(1 - 0.95) ELSE ln(0.95) END
        + ln(1 - levenshtein(term, token) / least(length(term), length(token))::DOUBLE) AS w, 1 - levenshtein(term, token) / least(length(term), length(token))::DOUBLE AS s
      FROM q JOIN vocab ON left(term, 1) = left(token, 1) WHERE length(term) >= 4 AND levenshtein(term, token) <= 2 AND term <> token
      UNION ALL SELECT position, token, df, ln(0.95), 1 FROM q JOIN vocab ON term = token),
    r AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY s DESC, df DESC, term) AS r FROM c),
    o AS (SELECT position, term, df, w FROM r WHERE r <= 3 UNION ALL SELECT position, token, 0, ln(1 - 0.95) FROM q
      WHERE token NOT IN (SELECT term FROM vocab)),
    b AS (SELECT w[i] AS w1, w[i + 1] AS w2, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM
      (SELECT {tok('text')} AS w FROM documents)) GROUP BY 1, 2),
    p AS (SELECT x.term || ' ' || y.term || ' ' || z.term AS phrase, x.w + ln((x.df + 0.5) / (f + 0.5 * v))
        + y.w + ln((coalesce(b1.n, 0) + 0.5) / (x.df + 0.5 * v)) + z.w + ln((coalesce(b2.n, 0) + 0.5) / (y.df + 0.5 * v)) AS score
      FROM st, o x JOIN o y ON y.position = 1 JOIN o z ON z.position = 2
      LEFT JOIN b b1 ON b1.w1 = x.term AND b1.w2 = y.term LEFT JOIN b b2 ON b2.w1 = y.term AND b2.w2 = z.term WHERE x.position = 0)
    SELECT phrase, round(score, 6) AS score FROM p ORDER BY p.score DESC, phrase LIMIT 3""")
def _(t):
    s = suggest.suggest_phrase(t.documents, "doc_id", "text", " ".join(_WORDS), size=3, vocab=text_index(t).terms())
    return s.withColumn("score", F.round("score", 6))


@query("bigrams", f"""SELECT w[i] AS w1, w[i + 1] AS w2, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM
    (SELECT {tok('text')} AS w FROM documents)) GROUP BY 1, 2""")
def _(t):
    return suggest.bigrams(t.documents, "text")


def _inputs(t):
    # both words of a part name complete it; bigger parts weigh more
    return suggest.completion_rows(t.part, "p_partkey", F.array_distinct(F.concat(
        F.array("p_name"), F.slice(F.split("p_name", " "), 2, 1))), F.col("p_size"), ["p_type"])


INPUTS = """rows_ AS (SELECT p_partkey, p_type, p_size AS weight, unnest(list_distinct([p_name, string_split(p_name, ' ')[2]])) AS input FROM part)"""


@query("suggest_completion", f"""WITH {INPUTS}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY weight DESC, input) AS r
    FROM rows_ WHERE input LIKE 'gi%') SELECT p_partkey, input, weight FROM b WHERE r = 1 ORDER BY weight DESC, input, p_partkey LIMIT 8""")
def _(t):
    return suggest.suggest_completion(_inputs(t), "Gi", "p_partkey", size=8).select("p_partkey", "input", "weight")


@query("suggest_completion_batch", f"""WITH {INPUTS}, p AS (SELECT DISTINCT left(p_name, 4) AS prefix FROM part),
    r AS (SELECT prefix, p_partkey, input, weight, row_number() OVER (PARTITION BY prefix ORDER BY weight DESC, input, p_partkey) AS rank
      FROM p JOIN rows_ ON starts_with(input, trim(prefix))) SELECT prefix, p_partkey, input, weight, rank FROM r WHERE rank <= 3""")
def _(t):
    prefixes = t.part.select(F.substring("p_name", 1, 4).alias("prefix")).distinct()
    s = suggest.suggest_completion_batch(_inputs(t), prefixes, "prefix", "p_partkey", size=3)
    return s.select("prefix", "p_partkey", "input", "weight", F.col("rank").cast("long").alias("rank"))


@query("suggest_context", f"""WITH {INPUTS} SELECT p_partkey, input, weight FROM rows_ WHERE input LIKE 'red b%' AND p_type = 'ECONOMY'
    ORDER BY weight DESC, input, p_partkey LIMIT 5""")
def _(t):
    s = suggest.suggest_completion(_inputs(t), "red b", "p_partkey", context=F.col("p_type") == "ECONOMY")
    return s.select("p_partkey", "input", "weight")


@query("suggest_hits", f"""WITH {INPUTS}, s AS (SELECT p_partkey, input FROM rows_ WHERE input LIKE 'bolt%' ORDER BY weight DESC, input, p_partkey LIMIT 5)
    SELECT p_partkey, input, p_name, p_brand FROM s JOIN part USING (p_partkey)""")
def _(t):
    s = suggest.suggest_completion(_inputs(t), "bolt", "p_partkey")
    return suggest.suggest_hits(s, t.part, "p_partkey").select("p_partkey", "input", "p_name", "p_brand")


_COMPLETIONS: dict[tuple, CompletionIndex] = {}


def completions(t) -> CompletionIndex:
    """The stored completions of the parts, built by the first query of a session that needs them."""
    key = (t.spark.sparkContext.applicationId, t.folder, state(t.part))
    if key not in _COMPLETIONS:
        _COMPLETIONS[key] = CompletionIndex.build(_inputs(t), "p_partkey", scratch(t, "completions"), contexts=["p_type"])
    return _COMPLETIONS[key]


@query("completion_indexed", f"""WITH {INPUTS}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY weight DESC, input) AS r
    FROM rows_ WHERE input LIKE 'gi%') SELECT p_partkey, input, weight FROM b WHERE r = 1 ORDER BY weight DESC, input, p_partkey LIMIT 8""")
def _(t):
    return completions(t).suggest("Gi", size=8)


@query("completion_context_indexed", f"""WITH {INPUTS}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY weight DESC, input) AS r
    FROM rows_ WHERE input LIKE 'red b%' AND p_type = 'ECONOMY') SELECT p_partkey, input, weight FROM b WHERE r = 1
    ORDER BY weight DESC, input, p_partkey LIMIT 5""")
def _(t):
    return completions(t).suggest("red b", context=("p_type", "ECONOMY"))


@query("completion_all_indexed", f"""WITH {INPUTS}, p AS (SELECT DISTINCT left(p_name, 3) AS prefix FROM part),
    o AS (SELECT prefix, p_partkey, input, weight, row_number() OVER (PARTITION BY prefix, p_partkey ORDER BY weight DESC, input) AS n
      FROM p JOIN rows_ ON starts_with(input, trim(prefix))),
    r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY weight DESC, input, p_partkey) AS rank FROM o WHERE n = 1)
    SELECT prefix, p_partkey, input, weight, rank FROM r WHERE rank <= 4""")
def _(t):
    out = completions(t).suggest_all(t.part.select(F.substring("p_name", 1, 3).alias("p")), "p", size=4)
    return out.withColumn("rank", F.col("rank").cast("long"))


# --- conversions ----------------------------------------------------------------------------------------


@query("parse_date", """WITH d AS (SELECT o_orderkey, o_orderdate AS d, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 'O' THEN strftime(o_orderdate, '%d.%m.%Y') ELSE 'unknown' END AS s FROM orders)
    SELECT o_orderkey, CASE WHEN s <> 'unknown' THEN strftime(d, '%Y%m%d') END AS day FROM d""")
def _(t):
    d = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd")).when(
        F.col("o_orderstatus") == "O", F.date_format(d, "dd.MM.yyyy")).otherwise("unknown")
    parsed = convert.parse_date(text, ["strict_date", "dd.MM.yyyy"])
    return t.orders.select("o_orderkey", convert.format_date(parsed, "basic_date").alias("day"))


@query("parse_epoch", """SELECT event_id, epoch_us(ts) // 1000000 AS seconds, epoch_us(ts) // 1000 AS millis FROM events""")
def _(t):
    ts = F.col("ts").cast("timestamp")
    millis = convert.parse_date(F.unix_millis(ts).cast("string"), "epoch_millis")
    seconds = convert.parse_date(F.floor(F.unix_millis(ts) / 1000).cast("string"), ["strict_date", "epoch_second"])
    return t.events.select("event_id", F.unix_seconds(seconds).alias("seconds"), F.unix_millis(millis).alias("millis"))


@query("format_date", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%j') AS ordinal FROM events")
def _(t):
    return t.events.select("event_id", convert.format_date(F.col("ts"), "date_hour_minute_second").alias("iso"),
                           convert.format_date(F.col("ts"), "ordinal_date").alias("ordinal"))


@query("range_convert", """SELECT p_partkey, p_size AS lo, CASE WHEN p_size % 2 = 0 THEN p_size + 10 END AS hi,
    CASE WHEN p_size % 2 = 0 THEN '{"gte":' || p_size || ',"lt":' || p_size + 10 || '}' ELSE '{"gte":' || p_size || '}' END AS json FROM part""")
def _(t):
    size = F.col("p_size")
    text = F.when(size % 2 == 0, F.format_string('{"gte": %d, "lt": %d}', size, size + 10)).otherwise(
        F.format_string('{"gte": %d}', size))
    df = t.part.select("p_partkey", convert.range_from_json(text, "int").alias("r"))
    return df.select("p_partkey", "r.lo", "r.hi", convert.range_to_json(F.col("r")).alias("json"))


@query("base64", "SELECT p_partkey, to_base64(encode(p_name)) AS coded, p_name AS back FROM part")
def _(t):
    coded = convert.to_base64(F.col("p_name"))
    return t.part.select("p_partkey", coded.alias("coded"), convert.from_base64(coded).cast("string").alias("back"))


_UUID = "upper(substr(md5(p_name), 1, 8) || '-' || substr(md5(p_name), 9, 4) || '-' || substr(md5(p_name), 13, 4) || '-' || substr(md5(p_name), 17, 4) || '-' || substr(md5(p_name), 21, 12))"


@query("uuid", f"SELECT p_partkey, lower({_UUID}) AS id, NULL::VARCHAR AS broken FROM part")
def _(t):
    h = F.md5("p_name")
    text = F.upper(F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
    return t.part.select("p_partkey", convert.parse_uuid(text).alias("id"), convert.parse_uuid(F.col("p_name")).alias("broken"))


@query("decimal", "SELECT p_partkey, round(p_retailprice, 2)::DOUBLE AS price FROM part")
def _(t):
    return t.part.select("p_partkey", convert.decimal_to_double(F.col("p_retailprice").cast("decimal(12,2)")).alias("price"))


@query("json_map", "SELECT event_id, props->>'k' AS k, event_type AS \"meta.kind\", user_id AS \"meta.who\" FROM events")
def _(t):
    df = t.events.select("event_id", convert.json_path(F.col("props"), "k").alias("k"),
                         F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("who")).alias("meta"))
    return convert.flatten_struct(df)


@query("kebab_case", "SELECT c_custkey AS \"c-custkey\", c_mktsegment AS \"c-mktsegment\" FROM customer")
def _(t):
    return convert.rename_fields(t.customer.select("c_custkey", "c_mktsegment"))


@query("bind_params", """SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', 'it''s "quoted"') AND o_totalprice > 200000""")
def _(t):
    text = "SELECT o_orderkey FROM orders WHERE array_contains(:kinds, o_orderpriority) AND o_totalprice > :low"
    return S.sql(t.spark, text, {"orders": t.orders}, args={"kinds": ["1-URGENT", "it's \"quoted\""], "low": 200000})


# --- SQL ---------------------------------------------------------------------------------------------------


@query("sql", """SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders
    WHERE o_orderpriority = '2-HIGH' GROUP BY 1""")
def _(t):
    text = "SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1"
    return S.sql(t.spark, text, {"orders": t.orders}, filters={"orders": F.col("o_orderpriority") == "2-HIGH"})


@query("sql_fetch_size", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def _(t):
    return S.sql(t.spark, "SELECT event_id, value FROM events ORDER BY value DESC, event_id", {"events": t.events}, fetch_size=100)


@query("sql_time_zone", "SELECT event_id, ts + INTERVAL 9 HOUR AS ts FROM events")
def _(t):
    out = S.sql(t.spark, "SELECT event_id, ts FROM events", {"events": t.events}, time_zone="Asia/Tokyo")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("sql_params", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 20000")
def _(t):
    return S.sql(t.spark, "SELECT o_orderkey FROM orders WHERE o_orderstatus = ? AND o_totalprice BETWEEN ? AND ?",
                 {"orders": t.orders}, args=["F", 1000, 20000])


@query("search_template", """SELECT c_custkey, 'sql' AS how FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 8000
    UNION ALL SELECT c_custkey, 'python' FROM customer WHERE c_nationkey = 4""")
def _(t):
    saved = S.TemplateRegistry(t.spark)
    saved.put("rich", "SELECT c_custkey, 'sql' AS how FROM customer WHERE c_mktsegment = :segment AND c_acctbal > :low")
    saved.put("of_nation", lambda tables, nation: Search(tables["customer"], DocSchema.of(tables["customer"])).query(
        C.is_("c_nationkey", nation)).matches().select("c_custkey", F.lit("python").alias("how")))
    a, b = saved.multi_search([("rich", {"segment": "BUILDING", "low": 8000}), ("of_nation", {"nation": 4})],
                              {"customer": t.customer})
    return a.unionByName(b)


# --- streams ------------------------------------------------------------------------------------------------


def _stream(t):
    # several files by time, so several batches that have to agree with the one table
    path = scratch(t, "events")
    t.events.repartitionByRange(5, "ts").write.parquet(path)
    return streams.read_stream(t.spark, path, t.events.schema, pattern="*.parquet", files_per_batch=1)


def _finish(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("stream_bulk_save", "SELECT event_id, user_id, upper(event_type) AS event_type FROM events")
def _(t):
    folder = scratch(t, "bulk-save")
    target = Collection(t.spark, os.path.join(folder, "data"), id="event_id", buckets=4)
    stream = _stream(t).select("event_id", "user_id", "event_type")
    target.create(stream.schema)
    hooks = writes.RowHooks().add("before_save", lambda d: d.withColumn("event_type", F.upper("event_type")))
    _finish(streams.stream_bulk_save(stream, target, os.path.join(folder, "checkpoint"), hooks=hooks))
    return target.read()


@query("stream_version_upsert", """SELECT user_id, event_id AS seq, ts, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def _(t):
    folder = scratch(t, "upsert")
    target = Collection(t.spark, os.path.join(folder, "data"), id="user_id", buckets=4)
    stream = _stream(t).select("user_id", F.col("event_id").alias("seq"), "ts", "value")
    target.create(stream.schema)
    _finish(streams.stream_version_upsert(stream, target, os.path.join(folder, "checkpoint"), "ts", order="seq"))
    return target.read()


@query("stream_filter", "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 50")
def _(t):
    folder = scratch(t, "filter")
    target = Collection(t.spark, os.path.join(folder, "data"), id="event_id", buckets=4)
    node = C.is_("event_type", "purchase") & C.gt("value", 50.0)
    stream = streams.stream_filter(_stream(t), DocSchema.of(t.events), node).select("event_id", "value")
    target.create(stream.schema)
    _finish(streams.stream_bulk_save(stream, target, os.path.join(folder, "checkpoint")))
    return target.read()


@query("stream_aggregate", """SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total
    FROM events GROUP BY 1, 2""")
def _(t):
    folder = scratch(t, "aggregate")
    target = Collection(t.spark, os.path.join(folder, "data"), id="bucket_id", buckets=4)
    target.create("event_type string, n long, total double, window_start timestamp, window_end timestamp, bucket_id string")
    stream = _stream(t).withColumn("ts", F.col("ts").cast("timestamp"))
    _finish(streams.stream_aggregate(stream, target, os.path.join(folder, "checkpoint"), "ts", "6 hours", ["event_type"],
                                     [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")], late="400 days"))
    return target.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@query("stream_all", """SELECT b AS _batch, count(*) AS n, min(event_id) AS first_key, max(event_id) AS last_key FROM
    (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 500 AS b FROM events) GROUP BY 1""")
def _(t):
    # everything in batches of 500 in the order of the keys, numbered without a sort in one place
    s = Search(t.events, DocSchema.of(t.events, id="event_id"))
    return s.batches(500).groupBy("_batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_key"), F.max("event_id").alias("last_key"))
