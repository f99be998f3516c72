"""The numbered queries over the given tables, with their production parameters and SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import (decontamination, fingerprints, htmltext, merkle, mixing, packing, secrets, simhash, substrings, toxicity,
               trie, urls, warc)
from .common import pinned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


ORACLES["op4_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('20240601' || coalesce(':' || doc_id, '')), 1, 3))::INT AS slot
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
  FROM totals),
ratios AS (
  SELECT *, cap / weight AS ratio,
         coalesce(sum(cap) OVER w, 0) AS below, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
  FROM weighed WINDOW w AS (ORDER BY cap / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)),
levels AS (
  SELECT arg_min((1.5 * (SELECT sum(source_size) FROM totals) - below)::DOUBLE / rest::DOUBLE, ratio) AS level
  FROM ratios WHERE (1.5 * (SELECT sum(source_size) FROM totals) - below)::DOUBLE / rest::DOUBLE <= ratio),
goals AS (
  SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target,
         CASE WHEN source_size > 0 THEN least(cap::DOUBLE, level * weight) / source_size ELSE 0 END AS rate
  FROM weighed, levels),
slots AS (
  SELECT source, slot, sum(sum(size)) OVER (PARTITION BY source ORDER BY slot) - sum(size) / 2 AS reach
  FROM docs GROUP BY source, slot),
cuts AS (
  SELECT g.source, g.source_size, g.target, floor(g.rate)::BIGINT AS whole,
         coalesce(max(CASE WHEN reach <= (rate - floor(rate)) * source_size AND rate > floor(rate)
                           THEN slot END), -1) AS cut
  FROM goals g JOIN slots s ON g.source IS NOT DISTINCT FROM s.source GROUP BY ALL)
SELECT doc_id, size, source_size, target, (size * (whole + (slot <= cut)::BIGINT))::BIGINT AS taken
FROM docs d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


#: Rules of the URL query: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES, urls.train(spark))


@query
def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.without_repeats(table(spark, folder, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"])
    kinds = F.transform("base", lambda s: s["kind"])
    number = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *number,
                        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
                        secrets.written(F.col("spans")).alias("spans"))


@query
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = fingerprints.edited(table(spark, folder, "documents"))
    return fingerprints.compared(pairs, F.length("text").cast("long").alias("n_chars"),
                                 F.sha2("edited", 256).alias("edited_sha256")).withColumnRenamed("id", "doc_id")


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    place = os.path.join(checkpoint_dir(spark), "warc", uuid.uuid4().hex)
    # the list of archives is pinned, so that they are written once
    read = warc.records(pinned(warc.archived(table(spark, folder, "pages"), place)))
    return read.select(F.col("id").alias("page_id"), F.col("length").alias("payload_bytes"),
                       F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""


@query
def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    out = packing.packed(table(spark, folder, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    length = F.octet_length("ids") / packing.WIDTH
    return out.select("doc_id", "piece", "start", length.cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                      "sequence_id", "offset")


@query
def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    seqs = trie.sequences(table(spark, folder, "conversations"))
    shares = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return trie.prefix_trie(trie.with_shared_start(seqs, shares, F.col("conv_id") - F.col("conv_id") % 100, 5))


ORACLES["op12_trie"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shares AS (
  SELECT conv_id, s, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h FROM own, crc),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1:h], []), a.s[h + 1:]) AS s
  FROM shares a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
members AS (SELECT conv_id, u.d AS d, s[1:u.d] AS p, len(s) AS l FROM rebuilt, unnest(range(len(s) + 1)) AS u(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(p[d].said), 0) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE l = d), '')) AS ends_sha256
  FROM members GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
subtrees AS (
  SELECT c.p[1:u.k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM counted c, unnest(range(d + 1)) AS u(k) GROUP BY ALL)
SELECT c.conv_id, c.d AS depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (p) LEFT JOIN nodes up ON c.d > 0 AND up.p = c.p[1:c.d - 1]
"""


@query
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.manifest(table(spark, folder, "documents"), fields, claimed=F.when(chosen, merkle.digest(tampered)))
    return out.withColumn("proof_sha256", F.sha2(F.array_join("proof", ""), 256)).drop("proof")


def _written(*values: str) -> str:
    return " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values)


def _levels(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT tree, 0 AS level, nr, h, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, nr // 2, sha256(string_agg(h, '' ORDER BY nr)), (n + 1) // 2 FROM {name} WHERE n > 1
  GROUP BY tree, level, nr // 2, n)"""


def _steps(leaves: str, levels: str) -> str:
    """The sibling of each leaf's ancestors: side 0 alone, 1 on the right, 2 on the left."""
    return f"""SELECT l.tree, l.nr, u.k AS level, CASE WHEN s.h IS NULL THEN 0 WHEN (l.nr >> u.k) & 1 = 0 THEN 1 ELSE 2 END AS side, s.h
  FROM {leaves} l, unnest(range(ceil(log2(l.n))::BIGINT)) AS u(k)
  LEFT JOIN {levels} s ON s.tree IS NOT DISTINCT FROM l.tree AND s.level = u.k AND s.nr = xor(l.nr >> u.k, 1)"""


ORACLES["op13_merkle"] = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
  SELECT doc_id, lang AS tree, sha256({_written("doc_id", "source", "lang", "n_chars", "text")}) AS h,
         sha256({_written("doc_id", "source", "lang", "n_chars + 1", "text")}) AS tampered,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 AS chosen FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS nr, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed),
{_levels("levels", "leaves")},
tops AS (SELECT tree AS lang, h FROM levels WHERE n = 1),
subroots AS (
  SELECT 0 AS tree, lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS nr, count(*) OVER () AS n FROM tops),
{_levels("over", "subroots")},
low AS ({_steps("leaves", "levels")}),
high AS ({_steps("subroots", "over")}),
steps AS (
  SELECT tree, nr, 0 AS part, level, side, h FROM low
  UNION ALL
  SELECT l.tree, l.nr, 1, s.level, s.side, s.h FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.tree
  JOIN high s ON s.nr = r.nr),
paths AS (
  SELECT tree, nr, list(struct_pack(side := side, h := h) ORDER BY part, level) AS path,
         string_agg(h, '' ORDER BY part, level) AS beside FROM steps GROUP BY tree, nr)
SELECT doc_id, l.h AS leaf, r.h AS subroot, o.h AS root, sha256(coalesce(beside, '')) AS proof_sha256,
       list_reduce(list_concat([struct_pack(side := 0, h := CASE WHEN chosen = 0 THEN tampered ELSE l.h END)], coalesce(path, [])),
         lambda a, b: struct_pack(side := 0, h := CASE b.side WHEN 0 THEN sha256(a.h) WHEN 1 THEN sha256(a.h || b.h)
                                             ELSE sha256(b.h || a.h) END)).h AS folded_root,
       folded_root = root AS verified
FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.tree, (SELECT h FROM over WHERE n = 1) o
LEFT JOIN paths p ON p.tree IS NOT DISTINCT FROM l.tree AND p.nr = l.nr
"""
