"""Nested objects and parent/child relations."""

from pyspark.sql import functions as F

from docspark.operators import nested, relations
from docspark.plans import criteria as C
from docspark.plans.search import Order, Search
from docspark.schema import DocSchema
from docspark.sources.related import RelatedTables

from .registry import Tables, query, scratch

# --- nested: the lines of a text and their words, which the text itself holds ------------------------

L = """ls AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents), l AS (SELECT doc_id, lang, i, line, length(line) AS size, len(string_split(line, ' ')) AS words FROM ls)"""


def texts(t: Tables):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        x.alias("line"), F.length(x).alias("size"), F.size(F.split(x, " ")).alias("words")))
    return t.documents.select("doc_id", "lang", lines.alias("lines"))


def search(t: Tables) -> Search:
    df = texts(t)
    return Search(df, DocSchema.of(df, id="doc_id", text=["lines.line"]))


@query("nested_query", f"WITH {L} SELECT DISTINCT doc_id FROM l WHERE size BETWEEN 10 AND 15")
def _(t):
    return search(t).query(C.between("lines.size", 10, 15)).matches().select("doc_id")


@query("nested_text", f"""WITH {L} SELECT DISTINCT doc_id FROM l
    WHERE regexp_matches(lower(line), '(^|[^\\p{{L}}\\p{{N}}])hehely($|[^\\p{{L}}\\p{{N}}])')""")
def _(t):
    return search(t).query(C.is_("lines.line", "Hehely")).matches().select("doc_id")


@query("nested_score", f"WITH {L} SELECT doc_id, round(avg(words), 6) AS _score FROM l WHERE size > 200 GROUP BY 1")
def _(t):
    df = texts(t)
    score = nested.nested_score("lines", lambda x: x["size"] > 200, lambda x: x["words"].cast("double"))
    return df.withColumn("_score", F.round(score, 6)).where("_score IS NOT NULL").select("doc_id", "_score")


@query("nested_same_element", f"""WITH {L} SELECT doc_id, bool_or(size > 200) AND bool_or(words < 5) AS apart,
    bool_or(size > 200 AND words < 40) AS together FROM l GROUP BY 1""")
def _(t):
    long_, short = (lambda x: x["size"] > 200), (lambda x: x["words"] < 5)
    return texts(t).select(
        "doc_id", (nested.nested_match("lines", long_) & nested.nested_match("lines", short)).alias("apart"),
        nested.nested_match("lines", lambda x: (x["size"] > 200) & (x["words"] < 40)).alias("together"))


@query("include_in_parent", f"WITH {L} SELECT doc_id FROM l GROUP BY 1 HAVING bool_or(words = 7)")
def _(t):
    df = nested.include_in_parent(texts(t), "lines", "words")
    return Search(df, DocSchema.of(df)).query(C.is_("lines_words", 7)).matches().select("doc_id")


@query("inner_hits", f"""WITH {L}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r,
      count(*) OVER (PARTITION BY doc_id) AS total FROM l WHERE words > 20)
    SELECT doc_id, total::INT AS total, string_agg(i || ':' || size, ' ' ORDER BY i) AS hits FROM r WHERE r BETWEEN 2 AND 4 GROUP BY 1, 2""")
def _(t):
    h = nested.inner_hits(texts(t), "lines", lambda x: x["words"] > 20, start=1, size=3, total="total")
    text = F.transform("inner_hits", lambda p: F.concat_ws(":", p["offset"].cast("string"), p["hit"]["size"].cast("string")))
    return h.where(F.size("inner_hits") > 0).select("doc_id", "total", F.array_join(text, " ").alias("hits"))


@query("inner_hits_levels", """WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(range(len(ls)))::INT AS i, unnest(ls) AS line FROM a),
    w AS (SELECT doc_id, i, unnest(range(len(string_split(line, ' '))))::INT AS j, unnest(string_split(line, ' ')) AS word FROM l)
    SELECT doc_id, i AS line_no, j AS word_no FROM w WHERE word = 'hehely'""")
def _(t):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.transform(
        F.split(x, " "), lambda w: F.struct(w.alias("word"))).alias("words")))
    df = t.documents.select("doc_id", lines.alias("lines"))
    rows = nested.inner_hits_rows(df, "doc_id", ["lines", "words"], lambda x: x["word"] == "hehely")
    return rows.select("doc_id", F.col("_offset_0").alias("line_no"), F.col("_offset_1").alias("word_no"))


@query("sort_nested", f"""WITH {L}, k AS (SELECT doc_id, max(size) FILTER (words > 10) AS k FROM l GROUP BY 1)
    SELECT doc_id, k::INT AS k FROM k ORDER BY k DESC NULLS LAST, doc_id LIMIT 50""")
def _(t):
    s = search(t).sort(Order("lines.size", nested_filter=lambda x: x["words"] > 10).desc()).limit(50)
    return s.sort_values().select("doc_id", F.col("_sort_0").alias("k"))


@query("nested_agg", f"""WITH {L} SELECT lang, count(*) AS lines, count(DISTINCT doc_id) AS docs, sum(words)::BIGINT AS words
    FROM l WHERE words > 3 GROUP BY 1""")
def _(t):
    rows = nested.nested_rows(texts(t), "lines", "doc_id", "lang").where("_element.words > 3")
    # per document first: what meets in a language is one row per document
    per_doc = rows.groupBy("lang", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("_element.words").alias("w"))
    return per_doc.groupBy("lang").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("docs"), F.sum("w").alias("words"))


# --- parents and children ---------------------------------------------------------------------------------


@query("has_child", """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R')""")
def _(t):
    return relations.has_child(t.orders, t.lineitem, "o_orderkey", "l_orderkey",
                               (F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R")).select("o_orderkey", "o_orderstatus")


def _children(mode):
    return f"""SELECT o_orderkey, round({mode}(l_extendedprice), 2) AS _score FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_discount >= 0.05 GROUP BY 1 HAVING count(*) BETWEEN 2 AND 4"""


def _child_scores(t, mode):
    out = relations.has_child(t.orders, t.lineitem, "o_orderkey", "l_orderkey", F.col("l_discount") >= 0.05,
                              min_children=2, max_children=4, score_mode=mode, child_score=F.col("l_extendedprice"))
    return out.select("o_orderkey", F.round("_score", 2).alias("_score"))


@query("has_child_min_max", _children("sum"))
def _(t):
    return _child_scores(t, "sum")


@query("has_child_colocated", _children("sum"))
def _(t):
    # both sides in buckets by the order: no row of either is shuffled
    stored = RelatedTables.build(t.orders, t.lineitem, scratch(t, "related"), parent_key="o_orderkey", child_key="l_orderkey", buckets=8)
    out = relations.has_child(stored.parents(), stored.children(), "o_orderkey", "l_orderkey", F.col("l_discount") >= 0.05,
                              min_children=2, max_children=4, score_mode="sum", child_score=F.col("l_extendedprice"))
    return out.select("o_orderkey", F.round("_score", 2).alias("_score"))


@query("has_child_max_score", _children("max"))
def _(t):
    return _child_scores(t, "max")


@query("has_child_min_score", _children("min"))
def _(t):
    return _child_scores(t, "min")


@query("has_child_avg_score", """SELECT o_orderkey, round(avg(l_quantity), 4) AS _score FROM orders JOIN lineitem
    ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    out = relations.has_child(t.orders, t.lineitem, "o_orderkey", "l_orderkey", score_mode="avg", child_score=F.col("l_quantity"))
    return out.select("o_orderkey", F.round("_score", 4).alias("_score"))


@query("has_child_conversations", """SELECT conv_id, turn FROM conversations WHERE role = 'system' AND conv_id IN
    (SELECT conv_id FROM conversations WHERE role = 'assistant' AND length(text) > 200)""")
def _(t):
    c = t.conversations
    return relations.has_child(relations.same_index_relation(c, "role", "system"),
                               relations.same_index_relation(c, "role", "assistant"),
                               "conv_id", "conv_id", F.length("text") > 200).select("conv_id", "turn")


@query("has_parent", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN
    (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000)""")
def _(t):
    pred = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000)
    out = relations.has_parent(t.lineitem, t.orders, "l_orderkey", "o_orderkey", pred)
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query("has_parent_score", """SELECT l_orderkey, l_linenumber, l_partkey, o_totalprice AS _score FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 300000""")
def _(t):
    out = relations.has_parent(t.lineitem, t.orders, "l_orderkey", "o_orderkey", F.col("o_totalprice") > 300000,
                               parent_score=F.col("o_totalprice"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "_score")


@query("not_has_child", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 150000)""")
def _(t):
    pred = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 150000)
    return relations.not_has_child(t.customer, t.orders, "c_custkey", "o_custkey", pred).select("c_custkey")


@query("parent_id", "SELECT l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 77 AND l_linestatus = 'O'")
def _(t):
    return relations.parent_id(t.lineitem, "l_orderkey", 77, "l_linestatus", "O").select("l_linenumber", "l_partkey", "l_quantity")


@query("relation_levels", """SELECT r_regionkey AS root, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM region
    JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def _(t):
    leaves = relations.relation_levels([(t.region, "r_regionkey", None), (t.nation, "n_nationkey", "n_regionkey"),
                                        (t.customer, "c_custkey", "c_nationkey")], "root")
    return leaves.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("join_inner_hits", """WITH r AS (SELECT l_orderkey, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS r FROM lineitem WHERE l_returnflag = 'A')
    SELECT o_orderkey, o_orderstatus, string_agg(l_partkey::VARCHAR, ',' ORDER BY r) AS parts FROM orders
    JOIN r ON l_orderkey = o_orderkey WHERE r <= 2 GROUP BY 1, 2""")
def _(t):
    out = relations.join_inner_hits(
        t.orders, t.lineitem, "o_orderkey", "l_orderkey",
        (F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_linenumber")),
        ["l_partkey"], size=2, predicate=F.col("l_returnflag") == "A")
    parts = F.array_join(F.transform("inner_hits", lambda h: h["l_partkey"].cast("string")), ",")
    return out.select("o_orderkey", "o_orderstatus", parts.alias("parts"))
