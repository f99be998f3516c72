"""Relevance: scores, re-ranking, similar documents, vectors, highlighting, synonyms."""

from pyspark.sql import functions as F

from docspark.functions import analysis as A
from docspark.operators import highlight as H
from docspark.operators import scoring, vectors
from docspark.plans import criteria as C
from docspark.plans.search import Order, Search
from docspark.schema import DocSchema, FieldSpec
from docspark.sources.tables import multi_index
from docspark.sources.textindex import TextIndex
from docspark.sources.vectorindex import VectorIndex
from docspark.sources.vocabulary import Vocabulary

from .predicates import documents, orders
from .registry import Tables, padded, query, scratch, text_index, tok

# --- the scoring function in SQL ---------------------------------------------------------------


def bm25_sql(terms, where="true", table="documents", weights=None, k1=1.2, b=0.75):
    """CTEs up to ``scored(doc_id, _score, s0, s1, ..)`` for the given literal terms."""
    weights = weights or [1.0] * len(terms)
    tfs = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS f{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"sum((f{i} > 0)::INT)::DOUBLE AS d{i}" for i in range(len(terms)))
    score = [f"(CASE WHEN f{i} > 0 THEN {weights[i]} * ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * f{i} / "
             f"(f{i} + {k1} * (1 - {b} + {b} * l / avgl)) ELSE 0 END)" for i in range(len(terms))]
    parts = ", ".join(f"{s} AS s{i}" for i, s in enumerate(score))
    return f"""toks AS (SELECT *, {tok('text')} AS w FROM {table}),
    tf AS (SELECT * EXCLUDE (w), len(w) AS l, {tfs} FROM toks),
    st AS (SELECT sum((l > 0)::INT)::DOUBLE AS n, sum(l) / sum((l > 0)::INT)::DOUBLE AS avgl, {dfs} FROM tf),
    scored AS (SELECT *, {parts}, {' + '.join(score)} AS _score FROM tf, st WHERE {where})"""


def rounded(df, *columns, digits=6):
    return df.withColumn("_score", F.round("_score", digits)).select(*columns, "_score")


def scores(t: Tables, node, **kw):
    return documents(t).query(node).with_scores(index=text_index(t), **kw).matches()


@query("text_index", f"""SELECT term, count(DISTINCT doc_id) AS df, count(*) AS freq FROM
    (SELECT doc_id, unnest({tok('text')}) AS term FROM documents) GROUP BY term""")
def _(t):
    # built anew on each call: the cost of the index itself
    return TextIndex.build(t.documents, "doc_id", "text", scratch(t, "built-index")).terms()


@query("fuzzy_indexed", f"""SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest({tok('text')}) AS term FROM documents)
    WHERE levenshtein(term, 'thatin') <= 2""")
def _(t):
    # the vocabulary is searched instead of the texts
    index = text_index(t)
    return index.with_terms(index.near("thatin", 2))


@query("phrase_indexed", f"""SELECT doc_id, len(list_filter(range(1, len(w) - 1), lambda i: w[i] = 'the' AND w[i + 1] = 'of' AND w[i + 2] = 'and')) AS freq
    FROM (SELECT doc_id, {tok('text')} AS w FROM documents) WHERE freq > 0""")
def _(t):
    # positions of the terms, intersected: no text is read
    phrase = ("the", "of", "and")
    hits = text_index(t).frequencies(phrase, [phrase]).where("pf0 > 0")
    return hits.select(F.col("id").alias("doc_id"), F.col("pf0").alias("freq"))


@query("boolean_indexed", f"""SELECT doc_id, lang FROM (SELECT *, {tok('text')} AS w FROM documents)
    WHERE (contains({padded('text')}, ' of the ') OR len(list_filter(w, lambda x: x LIKE 'hehe%y')) > 0)
      AND NOT (list_contains(w, 'der') OR len(list_filter(w, lambda x: starts_with(x, 'zu'))) > 0) AND lang <> 'fr'""")
def _(t):
    node = C.Bool(should=(C.phrase("text", "of the"), C.wildcard("text", "hehe*y")), min_should=1,
                  must_not=(C.matches("text", "der"), C.starts_with("text", "zu"), C.is_("lang", "fr")))
    return documents(t).using(text_index(t)).query(node).matches().select("doc_id", "lang")


@query("patterns_indexed", f"""SELECT doc_id FROM (SELECT doc_id, {tok('text')} AS w FROM documents)
    WHERE len(list_filter(w, lambda x: regexp_full_match(x, 're[a-d]+.*'))) > 0 AND len(list_filter(w, lambda x: contains(x, 'hatin'))) > 0""")
def _(t):
    node = C.Bool(must=(C.regexp("text", "re[a-d]+.*"), C.contains("text", "hatin")))
    return documents(t).using(text_index(t)).query(node).matches().select("doc_id")


@query("index_updates", f"""WITH d AS (SELECT CASE WHEN doc_id % 5 = 2 THEN 'again ' || text ELSE text END AS text FROM documents WHERE doc_id % 7 <> 3)
    SELECT term, count(DISTINCT i) AS df, count(*) AS freq FROM
      (SELECT i, unnest({tok('text')}) AS term FROM (SELECT row_number() OVER () AS i, text FROM d)) GROUP BY term""")
def _(t):
    # a part at first, the rest in three pieces, some replaced, some deleted: as many terms as in a fresh index
    docs, key = t.documents.select("doc_id", "text"), F.col("doc_id")
    index = TextIndex.build(docs.where(key % 4 == 0), "doc_id", "text", scratch(t, "updated-index"))
    for part in (1, 2, 3):
        index = index.add(docs.where(key % 4 == part))
    index = index.upsert(docs.where(key % 5 == 2).withColumn("text", F.concat(F.lit("again "), "text")))
    return index.delete(docs.where(key % 7 == 3)).merge().terms()


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(t: Tables) -> Vocabulary:
    """The vocabulary of the stored index, built by the first query that needs it."""
    index = text_index(t)
    if index.path not in _VOCABULARIES:
        _VOCABULARIES[index.path] = Vocabulary.build(index.terms(), scratch(t, "vocabulary"))
    return _VOCABULARIES[index.path]


_TERMS = f"""SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({tok('text')}) AS term FROM documents) GROUP BY term"""


@query("terms_like", f"""WITH v AS ({_TERMS}) SELECT term, df, 'wildcard' AS found FROM v WHERE term LIKE 'the%ing'
    UNION ALL SELECT term, df, 'contains' FROM v WHERE contains(term, 'hatin')
    UNION ALL SELECT term, df, 'regexp' FROM v WHERE regexp_full_match(term, 'sch[a-m]+ung')""")
def _(t):
    # candidates by their grams: a small share of the vocabulary is compared
    v, out = vocabulary(t), None
    for op, value in (("wildcard", "the*ing"), ("contains", "hatin"), ("regexp", "sch[a-m]+ung")):
        hits = v.like(op, value).select("term", "df", F.lit(op).alias("found"))
        out = hits if out is None else out.unionAll(hits)
    return out


@query("fuzzy_batch", f"""WITH v AS ({_TERMS}), w AS (SELECT DISTINCT unnest({tok('text')}) AS word FROM benchmark),
    e AS (SELECT word, CASE WHEN length(word) < 3 THEN 0 WHEN length(word) < 6 THEN 1 ELSE 2 END AS edits FROM w)
    SELECT word, term, df FROM e JOIN v ON length(term) BETWEEN length(word) - edits AND length(word) + edits
    WHERE levenshtein(translate(word, 'èéßêçíöóüäñ', 'ABCDEFGHIJK'), translate(term, 'èéßêçíöóüäñ', 'ABCDEFGHIJK')) <= edits""")
def _(t):
    # the SQL function counts bytes, so it is given one for each letter of the texts;
    # every word of the benchmark asks for its near terms: one equi-join on what is left without some letters
    asked = t.benchmark.select(F.explode(A.tokens("text")).alias("word"))
    return vocabulary(t).near_all(asked, swaps=False).select("word", "term", "df")


ANY3 = ["rewh", "hehely", "of"]
ANY3_WHERE = "(f0 > 0 OR f1 > 0 OR f2 > 0)"


@query("bm25_score", f"WITH {bm25_sql(ANY3, ANY3_WHERE)} SELECT doc_id, round(_score, 6) AS _score FROM scored")
def _(t):
    return rounded(scores(t, C.matches("text", "rewh hehely of")), "doc_id")


@query("bm25_top", f"""WITH {bm25_sql(ANY3, ANY3_WHERE)} SELECT doc_id, round(_score, 6) AS _score
    FROM scored ORDER BY _score DESC, doc_id LIMIT 20""")
def _(t):
    # the blocks of postings that can hold one of the best
    s = documents(t).query(C.matches("text", "rewh hehely of")).with_scores(index=text_index(t))
    hits = s.sort(Order("_score", descending=True)).limit(20).fields("doc_id").best()
    return rounded(hits, "doc_id")


@query("bm25_page", f"""WITH {bm25_sql(['thatin', 'the'], '(f0 > 0 OR f1 > 0)', weights=[3.0, 1.0])}
    SELECT doc_id, lang, round(_score, 6) AS _score FROM scored ORDER BY _score DESC, doc_id LIMIT 10 OFFSET 20""")
def _(t):
    node = C.Bool(should=(C.term("text", "thatin").boost(3.0), C.matches("text", "the")))
    hits = documents(t).query(node).with_scores(index=text_index(t)).page(2).fields("doc_id", "lang").best()
    return rounded(hits, "doc_id", "lang")


@query("bm25_classic", f"""WITH {bm25_sql(['rewh', 'of'], '(f0 > 0 OR f1 > 0)')}
    SELECT doc_id, round(CASE WHEN f0 > 0 THEN sqrt(f0) * pow(1 + ln((n + 1) / (d0 + 1)), 2) / sqrt(l) ELSE 0 END
      + CASE WHEN f1 > 0 THEN sqrt(f1) * pow(1 + ln((n + 1) / (d1 + 1)), 2) / sqrt(l) ELSE 0 END, 6) AS _score
    FROM scored""")
def _(t):
    return rounded(scores(t, C.matches("text", "rewh of"), similarity="classic"), "doc_id")


BOOL_WHERE = "lang = 'en' AND f0 > 0 AND f3 = 0"
BOOL = bm25_sql(["of", "rewh", "hehely", "der"], BOOL_WHERE, weights=[1.0, 2.0, 1.0, 0.0])


@query("bool_score", f"WITH {BOOL} SELECT doc_id, round(_score, 6) AS _score FROM scored")
def _(t):
    node = C.Bool(must=(C.matches("text", "of"),),
                  should=(C.term("text", "rewh").boost(2.0), C.matches("text", "hehely")),
                  must_not=(C.term("text", "der"),), filter=(C.is_("lang", "en"),))
    return rounded(scores(t, node), "doc_id")


@query("phrase_score", f"""WITH {bm25_sql(['of', 'the'], 'true')}
    SELECT doc_id, round((ln(1 + (n - d0 + 0.5) / (d0 + 0.5)) + ln(1 + (n - d1 + 0.5) / (d1 + 0.5)))
      * pf / (pf + 1.2 * (1 - 0.75 + 0.75 * l / avgl)), 6) AS _score
    FROM (SELECT *, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS pf
          FROM scored JOIN (SELECT doc_id, w FROM toks) USING (doc_id)) WHERE pf > 0""")
def _(t):
    return rounded(scores(t, C.phrase("text", "of the")), "doc_id")


@query("constant_score", """SELECT doc_id, (CASE WHEN lang = 'en' THEN 3.0 ELSE 0 END
    + CASE WHEN n_chars < 500 THEN 1.5 ELSE 0 END)::DOUBLE AS _score FROM documents WHERE lang = 'en' OR n_chars < 500""")
def _(t):
    node = (C.ConstantScore(C.is_("lang", "en")).boost(3.0)
            | C.ConstantScore(C.lt("n_chars", 500)).boost(1.5))
    return rounded(scores(t, node), "doc_id")


@query("min_score", f"""WITH {bm25_sql(ANY3, ANY3_WHERE)} SELECT doc_id, round(_score, 6) AS _score
    FROM scored WHERE _score >= 2.5""")
def _(t):
    s = documents(t).query(C.matches("text", "rewh hehely of")).with_scores(index=text_index(t)).min_score(2.5)
    return rounded(s.matches(), "doc_id")


@query("track_scores", f"""WITH {bm25_sql(['thatin', 'orre'], '(f0 > 0 OR f1 > 0)')}
    SELECT doc_id, n_chars, round(_score, 6) AS _score FROM scored ORDER BY n_chars DESC, doc_id LIMIT 25""")
def _(t):
    s = documents(t).query(C.matches("text", "thatin orre")).with_scores(index=text_index(t))
    hits = s.sort(Order("n_chars").desc()).limit(25).fields("doc_id", "n_chars").hits()
    return rounded(hits, "doc_id", "n_chars")


@query("max_score", f"""WITH {bm25_sql(ANY3, ANY3_WHERE)} SELECT round(max(_score), 6) AS max_score FROM scored""")
def _(t):
    m = scoring.max_score(scores(t, C.matches("text", "rewh hehely of")))
    return m.select(F.round("max_score", 6).alias("max_score"))


@query("dfs_stats", f"""WITH {bm25_sql(ANY3, ANY3_WHERE)}, part AS (SELECT * FROM scored WHERE lang = 'de')
    SELECT doc_id, round(_score, 6) AS _score FROM part""")
def _(t):
    # statistics of the whole collection for a search in a part of it
    docs = t.documents
    schema = DocSchema.of(docs, text=["text"], id="doc_id")
    hits = scoring.with_score(docs.where("lang = 'de'"), schema, C.matches("text", "rewh hehely of"), index=text_index(t))
    return rounded(hits, "doc_id")


@query("explain", f"""WITH {bm25_sql(['of', 'rewh'], '(f0 > 0 OR f1 > 0)')}
    SELECT doc_id, 'of' AS term, f0::DOUBLE AS tf, d0 AS df, round(s0, 6) AS value FROM scored WHERE f0 > 0
    UNION ALL SELECT doc_id, 'rewh', f1::DOUBLE, d1, round(s1, 6) FROM scored WHERE f1 > 0""")
def _(t):
    hits = scores(t, C.matches("text", "of rewh"), explain=True)
    e = hits.select("doc_id", F.explode_outer("_explanation").alias("e")).where("e IS NOT NULL")
    return e.select("doc_id", "e.term", "e.tf", "e.df", F.round("e.value", 6).alias("value"))


BOTH = """both_texts AS (SELECT doc_id, text, 'documents' AS _index FROM documents
    UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark)"""


@query("indices_boost", f"""WITH {BOTH}, {bm25_sql(['of', 'thatin'], '(f0 > 0 OR f1 > 0)', 'both_texts')}
    SELECT doc_id, _index, round(_score * CASE _index WHEN 'benchmark' THEN 3.0 ELSE 1.0 END, 6) AS _score FROM scored""")
def _(t):
    both = multi_index({"documents": t.documents.select("doc_id", "text"),
                        "benchmark": t.benchmark.select(F.col("item_id").alias("doc_id"), "text")})
    s = Search(both, DocSchema.of(both, text=["text"]))
    hits = s.query(C.matches("text", "of thatin")).with_scores().indices_boost(benchmark=3.0).matches()
    return rounded(hits, "doc_id", "_index")


def _rescore_sql(combine):
    return f"""WITH {bm25_sql(['of', 'thatin', 'the'], 'f0 > 0')},
    first AS (SELECT *, row_number() OVER (ORDER BY s0 DESC, doc_id) AS r FROM scored)
    SELECT doc_id, (r > 50)::INT AS _rescored, round(CASE WHEN r > 50 THEN s0
      WHEN f1 > 0 OR f2 > 0 THEN {combine} ELSE s0 * 0.7 END, 6) AS _score FROM first"""


def _rescored(t, mode):
    docs = documents(t)
    index = text_index(t)
    hits = docs.query(C.term("text", "of")).with_scores(index=index).matches()
    out = scoring.rescore(hits, docs.schema, C.matches("text", "thatin the"), tie_break="doc_id", window=50,
                          mode=mode, query_weight=0.7, rescore_weight=1.2, index=index)
    return rounded(out, "doc_id", "_rescored")


@query("rescore", _rescore_sql("s0 * 0.7 + (s1 + s2) * 1.2"))
def _(t):
    return _rescored(t, "total")


@query("rescore_multiply", _rescore_sql("s0 * 0.7 * (s1 + s2) * 1.2"))
def _(t):
    return _rescored(t, "multiply")


@query("rescore_avg", _rescore_sql("(s0 * 0.7 + (s1 + s2) * 1.2) / 2"))
def _(t):
    return _rescored(t, "avg")


@query("rescore_max", _rescore_sql("greatest(s0 * 0.7, (s1 + s2) * 1.2)"))
def _(t):
    return _rescored(t, "max")


@query("rescore_min", _rescore_sql("least(s0 * 0.7, (s1 + s2) * 1.2)"))
def _(t):
    return _rescored(t, "min")


@query("function_score", """WITH e AS (SELECT event_id, event_type, value,
      exp(-pow(greatest(0, abs(value - 100) - 5), 2) / (2 * (-(pow(20, 2)) / (2 * ln(0.5))))) AS g FROM events)
    SELECT event_id, round(least(g + CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END, 2.5), 6) AS _score FROM e""")
def _(t):
    fs = scoring.function_score(
        F.lit(1.0), [(None, scoring.gauss_decay(F.col("value"), 100.0, 20.0, 0.5, 5.0)),
                     (F.col("event_type") == "purchase", F.lit(2.0))],
        score_mode="sum", boost_mode="replace", max_boost=2.5)
    return rounded(t.events.withColumn("_score", fs), "event_id")


@query("function_score_quality", f"""WITH {bm25_sql(['of', 'thatin'], '(f0 > 0 OR f1 > 0)')}
    SELECT doc_id, round(_score * CASE WHEN coalesce(quality, 0) = 1 THEN 2.0 ELSE 1.0 END, 6) AS _score
    FROM scored LEFT JOIN labels USING (doc_id)""")
def _(t):
    hits = scores(t, C.matches("text", "of thatin")).join(t.labels, "doc_id", "left")
    fs = scoring.function_score(F.col("_score"), [(F.col("quality") == 1, F.lit(2.0))])
    return rounded(hits.withColumn("_score", fs), "doc_id")


# --- postings and similar documents ----------------------------------------------------------------


@query("postings", f"""SELECT doc_id, term, count(*) AS tf, any_value(l) AS doc_len FROM
    (SELECT doc_id, len(w) AS l, unnest(w) AS term FROM (SELECT doc_id, {tok('text')} AS w FROM documents))
    GROUP BY doc_id, term""")
def _(t):
    p = scoring.postings(t.documents, "doc_id", "text")
    return p.select("doc_id", "term", "tf", F.col("doc_len").cast("long").alias("doc_len"))


@query("document_frequency", f"""SELECT term, count(DISTINCT doc_id) AS df, count(*) AS freq FROM
    (SELECT doc_id, unnest({tok('text')}) AS term FROM documents) GROUP BY term""")
def _(t):
    return scoring.vocabulary(t.documents, "doc_id", "text")


@query("term_positions", f"""SELECT doc_id, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT doc_id, {tok('text')} AS w FROM documents)) WHERE w[i] = 'hehely'""")
def _(t):
    p = scoring.positions(t.documents, "doc_id", "text").where("term = 'hehely'")
    return p.select("doc_id", F.col("pos").cast("long").alias("pos"))


@query("term_positions_indexed", f"""SELECT doc_id, w[i] AS term, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT doc_id, {tok('text')} AS w FROM documents)) WHERE w[i] IN ('hehely', 'rewh')""")
def _(t):
    p = text_index(t).positions("hehely", "rewh").select(F.col("id").alias("doc_id"), "term", F.explode("positions").alias("pos"))
    return p.withColumn("pos", F.col("pos").cast("long"))


@query("more_like_this", f"""WITH w AS (SELECT doc_id, {tok('text')} AS w FROM documents),
    post AS (SELECT doc_id, term, count(*) AS tf, any_value(l) AS l FROM
      (SELECT doc_id, len(w) AS l, unnest(w) AS term FROM w) GROUP BY doc_id, term),
    st AS (SELECT count(*)::DOUBLE AS n, avg(len(w)) AS avgl FROM w WHERE len(w) > 0),
    df AS (SELECT term, count(*) AS df FROM post GROUP BY term HAVING count(*) BETWEEN 5 AND 0.4 * (SELECT n FROM st)),
    src AS (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 1),
    sel AS (SELECT doc_id, term, df, tf * ln(1 + (n - df + 0.5) / (df + 0.5)) AS wt
      FROM post JOIN src USING (doc_id) JOIN df USING (term), st WHERE tf >= 2 AND length(term) >= 3),
    rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY wt DESC, term) AS r FROM sel),
    pick AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS nt FROM rk WHERE r <= 25),
    sc AS (SELECT p.doc_id AS source_id, d.doc_id, sum(ln(1 + (n - p.df + 0.5) / (p.df + 0.5)) * d.tf
        / (d.tf + 1.2 * (0.25 + 0.75 * d.l / avgl))) AS s, count(*) AS shared, max(nt) AS nt
      FROM pick p JOIN post d USING (term), st WHERE p.doc_id <> d.doc_id GROUP BY 1, 2),
    top AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY round(s, 9) DESC, doc_id) AS rank
      FROM sc WHERE shared >= greatest(1, floor(nt * 0.3)))
    SELECT source_id, doc_id, round(s, 6) AS _score FROM top WHERE rank <= 10""")
def _(t):
    sources = t.labels.where("quality = 1 AND toxic = 1").select("doc_id")
    m = scoring.more_like_this(t.documents, sources, "doc_id", "text", max_doc_share=0.4, min_word_len=3, index=text_index(t))
    return rounded(m, "source_id", "doc_id")


# --- vectors -------------------------------------------------------------------------------------------

# a query vector that the SQL can spell, too: alternating fractions
QUERY_VECTOR = [((i * 37) % 64) / 64.0 - 0.5 for i in range(64)]
VEC_SQL = "[" + ", ".join(repr(x) for x in QUERY_VECTOR) + "]::DOUBLE[]"
_VEC = "embedding::DOUBLE[] AS v, " + VEC_SQL + " AS q"
COS = "list_dot_product(v, q) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(q, q))"


@query("knn", f"""WITH e AS (SELECT vec_id, {_VEC} FROM embeddings)
    SELECT vec_id, round((1 + {COS}) / 2, 6) AS _score FROM e ORDER BY (1 + {COS}) / 2 DESC, vec_id LIMIT 10""")
def _(t):
    return rounded(vectors.knn(t.embeddings, "embedding", QUERY_VECTOR, 10, id="vec_id"), "vec_id")


@query("knn_filtered", f"""WITH e AS (SELECT vec_id, {_VEC} FROM embeddings WHERE label IN (1, 3, 5))
    SELECT vec_id, round(1 / (1 + list_sum(list_transform(range(1, 65), lambda i: pow(v[i] - q[i], 2)))), 6) AS _score
    FROM e ORDER BY list_sum(list_transform(range(1, 65), lambda i: pow(v[i] - q[i], 2))), vec_id LIMIT 7""")
def _(t):
    hits = vectors.knn(t.embeddings, "embedding", QUERY_VECTOR, 7, id="vec_id", metric="l2_norm",
                       filter=F.col("label").isin(1, 3, 5))
    return rounded(hits, "vec_id")


@query("knn_batch", """WITH c AS (SELECT label AS query_id, list(a ORDER BY i) AS q FROM
      (SELECT label, i, avg(embedding[i]::DOUBLE) AS a FROM embeddings, range(1, 65) r(i) GROUP BY label, i) GROUP BY label),
    s AS (SELECT query_id, vec_id, (1 + list_dot_product(v, q) / sqrt(list_dot_product(v, v))
        / sqrt(list_dot_product(q, q))) / 2 AS s FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), c)
    SELECT query_id, vec_id, round(s, 6) AS _score FROM
      (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS r FROM s) WHERE r <= 5""")
def _(t):
    # the mean vector of every label asks for its nearest rows
    mean = t.embeddings.groupBy("label").agg(F.array(*[
        F.avg(F.get("embedding", i).cast("double")) for i in range(64)]).alias("embedding"))
    hits = vectors.knn_batch(t.embeddings, mean, "embedding", 5, id="vec_id", query_id="label")
    return rounded(hits, "query_id", "vec_id")


def vector_index(t: Tables) -> VectorIndex:
    return VectorIndex.build(t.embeddings, "vec_id", "embedding", scratch(t, "vector-index"))


# every vector whose id is divisible by 20 asks for its ten nearest
@query("knn_index")
def _(t):
    # approximate: as many cells of each query as the build found enough; tests hold its recall at 0.9 or more
    asked = t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = vector_index(t).search(asked, 10, query_id="query_id")
    return rounded(hits, "query_id", "vec_id", "rank")


@query("knn_index_exact", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, e.vec_id, (1 + list_dot_product(e.v, q.v) / sqrt(list_dot_product(e.v, e.v))
        / sqrt(list_dot_product(q.v, q.v))) / 2 AS s FROM e, e q WHERE q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id)
    SELECT query_id, vec_id, round(s, 6) AS _score FROM
      (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS r FROM s) WHERE r <= 10""")
def _(t):
    # and the cells that can still hold a nearer one
    asked = t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = vector_index(t).search(asked, 10, query_id="query_id", exact=True, exclude_self=True)
    return rounded(hits, "query_id", "vec_id")


@query("knn_collapse", f"""WITH e AS (SELECT vec_id, label, {_VEC} FROM embeddings), s AS
      (SELECT vec_id, label, (1 + {COS}) / 2 AS s FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS r FROM s)
    SELECT label, vec_id, round(s, 6) AS _score FROM r WHERE r = 1""")
def _(t):
    from docspark.operators.collapse import best_per_key
    scored = t.embeddings.withColumn("_score", vectors.similarity_score(F.col("embedding"), QUERY_VECTOR))
    return rounded(best_per_key(scored, "label", (F.desc("_score"), F.asc("vec_id"))), "label", "vec_id")


@query("vector_similarity", f"""WITH e AS (SELECT vec_id, {_VEC} FROM embeddings), d AS (SELECT *,
      list_dot_product(v, q) AS ip, list_dot_product(v, v) AS vv, list_dot_product(q, q) AS qq,
      list_sum(list_transform(range(1, 65), lambda i: pow(v[i] - q[i], 2))) AS l2 FROM e)
    SELECT vec_id, round((1 + ip / sqrt(vv) / sqrt(qq)) / 2, 6) AS cosine, round((1 + ip) / 2, 6) AS dot_product,
      round(1 / (1 + l2), 6) AS l2_norm,
      round(CASE WHEN ip < 0 THEN 1 / (1 - ip) ELSE ip + 1 END, 6) AS max_inner_product FROM d""")
def _(t):
    return t.embeddings.select("vec_id", *[
        F.round(vectors.similarity_score(F.col("embedding"), QUERY_VECTOR, m), 6).alias(m)
        for m in vectors.SIMILARITIES])


@query("hybrid", f"""WITH {bm25_sql(['thatin', 'orre'], '(f0 > 0 OR f1 > 0)')},
    e AS (SELECT vec_id, {_VEC} FROM embeddings),
    k AS (SELECT vec_id, (1 + {COS}) / 2 AS s FROM e ORDER BY s DESC, vec_id LIMIT 50),
    u AS (SELECT doc_id, _score AS s FROM scored UNION ALL SELECT vec_id, s * 2 FROM k)
    SELECT doc_id, round(sum(s), 6) AS _score FROM u GROUP BY doc_id ORDER BY sum(s) DESC, doc_id LIMIT 40""")
def _(t):
    text = scores(t, C.matches("text", "thatin orre"))
    near = vectors.knn(t.embeddings, "embedding", QUERY_VECTOR, 50, id="vec_id").withColumnRenamed("vec_id", "doc_id")
    return rounded(vectors.hybrid(text, near, "doc_id", vector_weight=2.0, size=40), "doc_id")


# --- highlighting -------------------------------------------------------------------------------------

_MARK = r"(?i)(^|[^\p{L}\p{N}])(hehely|rewh)($|[^\p{L}\p{N}])"
# RE2 has no look-around, so the SQL marks twice: neighbours share a separator
_MARKED = (r"regexp_replace(regexp_replace(text, '(?i)(^|[^\p{L}\p{N}])(hehely|rewh)([^\p{L}\p{N}]|$)', "
           r"'\1<em>\2</em>\3', 'g'), '(?i)(^|[^\p{L}\p{N}>])(hehely|rewh)([^\p{L}\p{N}<]|$)', '\1<em>\2</em>\3', 'g')")


@query("highlight", f"""SELECT doc_id, {_MARKED} AS marked FROM documents
    WHERE list_has_any({tok('text')}, ['hehely', 'rewh'])""")
def _(t):
    s = documents(t)
    node = C.matches("text", "hehely rewh")
    hits = H.highlight(s.query(node).matches(), s.schema, node, [H.HighlightField("text", fragment_size=0)])
    return hits.select("doc_id", F.get(F.col("highlight")["text"], 0).alias("marked"))


@query("highlight_fragments", f"""WITH f AS (SELECT doc_id,
      regexp_extract_all(text, '(?s)(\\S.{{0,59}}\\S*)', 1) AS fr FROM documents),
    h AS (SELECT doc_id, list_filter(fr, lambda x: regexp_matches(x, '{_MARK}')) AS hit FROM f)
    SELECT doc_id, len(hit[1:3]) AS n, hit[1] AS first FROM h WHERE len(hit) > 0""")
def _(t):
    s = documents(t)
    node = C.matches("text", "hehely rewh")
    spec = H.HighlightField("text", pre_tag="", post_tag="", fragment_size=60, number_of_fragments=3)
    hits = H.highlight(s.query(node).matches(), s.schema, node, [spec])
    parts = F.col("highlight")["text"]
    return hits.select("doc_id", F.size(parts).cast("long").alias("n"), F.get(parts, 0).alias("first"))


@query("highlight_rename", """SELECT p_partkey, regexp_replace(p_name, '\\bgizmo\\b', '[gizmo]') AS marked
    FROM part WHERE p_name LIKE '% gizmo' OR p_name LIKE 'gizmo %'""")
def _(t):
    df = t.part
    schema = DocSchema.of(df, id="p_partkey", overrides=[FieldSpec("name", "text", "p_name")])
    node = C.matches("name", "gizmo")
    s = Search(df, schema).query(node)
    spec = H.HighlightField("name", pre_tag="[", post_tag="]", fragment_size=0, rename="p_name")
    hits = H.rename_keys(H.highlight(s.matches(), schema, node, [spec]), {"p_name": "name"})
    return hits.select("p_partkey", F.get(F.col("highlight")["name"], 0).alias("marked"))


# --- analyzers ------------------------------------------------------------------------------------------


@query("synonyms", f"""SELECT doc_id FROM documents
    WHERE list_has_any({tok('text')}, ['hehely', 'rewh', 'ononst'])""")
def _(t):
    df = t.documents
    analyzer = A.synonym_analyzer([("rewh", "hehely", "ononst"), ("der", "die")])
    schema = DocSchema.of(df, id="doc_id", overrides=[FieldSpec("text", "text", analyzer=analyzer)])
    return Search(df, schema).query(C.matches("text", "hehely")).matches().select("doc_id")


@query("search_as_you_type", f"""SELECT p_partkey, p_name FROM part WHERE list_contains({tok('p_name')}, 'small')
    AND len(list_filter({tok('p_name')}, lambda x: starts_with(x, 'gi'))) > 0""")
def _(t):
    df = t.part
    s = Search(df, DocSchema.of(df, text=["p_name"], id="p_partkey"))
    return s.query(C.search_as_you_type("p_name", "small gi")).matches().select("p_partkey", "p_name")


@query("tokens", f"""SELECT conv_id, turn, len({tok('text')}) AS n, array_to_string({tok('text')}, '|') AS standard,
    array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> ''), '|') AS simple
    FROM conversations""")
def _(t):
    return t.conversations.select(
        "conv_id", "turn", A.token_count("text").cast("long").alias("n"),
        F.array_join(A.tokens("text"), "|").alias("standard"),
        F.array_join(A.tokens("text", "simple"), "|").alias("simple"))


@query("sort_score", f"""WITH {bm25_sql(['the', 'de'], '(f0 > 0 OR f1 > 0)')}
    SELECT doc_id, round(_score, 6) AS _score FROM scored ORDER BY _score, doc_id LIMIT 30""")
def _(t):
    s = documents(t).query(C.matches("text", "the de")).sort(Order("_score")).limit(30)
    return rounded(s.hits(), "doc_id")


@query("multi_search", f"""WITH {bm25_sql(['thatin'], 'f0 > 0')},
    a AS (SELECT doc_id, NULL::BIGINT AS o_orderkey, 'texts' AS _query FROM scored ORDER BY _score DESC, doc_id LIMIT 10),
    b AS (SELECT NULL::BIGINT, o_orderkey, 'orders' FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
    SELECT * FROM a UNION ALL SELECT * FROM b""")
def _(t):
    from docspark.plans.search import multi_search
    return multi_search({
        "texts": documents(t).query(C.term("text", "thatin")).with_scores(),
        "orders": orders(t).query(C.is_("o_orderstatus", "F")).sort(Order("o_totalprice").desc()),
    }).select("doc_id", "o_orderkey", "_query")
