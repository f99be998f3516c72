"""URL filters: listed rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The small labelled table: 1 is blocked.
LABELLED = [
    ("https://www.casino-royal.example/slots/free-spins", 1), ("http://bestcasino.example/win/jackpot", 1),
    ("https://casino-bonus.example/en/", 1), ("http://lucky-win.example/poker", 1),
    ("https://free-bets.example/odds", 1), ("http://bets-now.example/live-betting", 1),
    ("http://cheap-pills.example/viagra", 1), ("https://pills-online.example/no-prescription", 1),
    ("http://discount-pharmacy.example/cheap/pills", 1), ("https://buy-meds.example/cheap", 1),
    ("http://adult-cams.example/xxx", 1), ("https://xxx-videos.example/adult", 1),
    ("http://hot-adult-x.example/free", 1), ("https://adult-dating.example/join", 1),
    ("http://ads-server.example/track?id=1", 1), ("https://track-clicks.example/ads/banner", 1),
    ("https://ads-track.example/pixel.gif", 1), ("http://click-track.example/out", 1),
    ("http://spam-links.example/farm", 1), ("https://link-farm.example/seo", 1),
    ("http://spam-farm.example/page/1", 1), ("https://seo-spam.example/backlinks", 1),
    ("http://free-download-warez.example/crack", 1), ("https://torrent-warez.example/keygen", 1),
    ("https://payday-loans.example/quick-cash", 1), ("http://quick-loans.example/apply", 1),
    ("http://replica-watches.example/rolex", 1), ("https://cheap-replica.example/bags", 1),
    ("https://www.city-library.example/en/catalogue", 0), ("https://news.example/world/2021/05/report", 0),
    ("http://blog.gardener.example/en/12/roses", 0), ("https://www.university.example/faculty/history", 0),
    ("http://m.weather.example/en/forecast", 0), ("https://docs.software.example/guide/install", 0),
    ("http://museum.example/collection/paintings", 0), ("https://blog.traveller.example/fr/41/paris", 0),
    ("https://www.recipes.example/soup/tomato", 0), ("http://encyclopedia.example/wiki/Physics", 0),
    ("https://forum.cyclists.example/thread/88", 0), ("http://www.school.example/timetable", 0),
    ("https://journal.science.example/articles/77", 0), ("http://theatre.example/programme", 0),
    ("https://www.railway.example/stations/north", 0), ("http://blog.teacher.example/de/7", 0),
    ("https://orchestra.example/season/2020", 0), ("http://www.farmers-market.example/opening", 0),
    ("https://hospital.example/departments", 0), ("http://village.example/history.html", 0),
    ("https://m.bookshop.example/en/novels", 0), ("http://archive.example/texts/letters", 0),
    ("https://www.thering.example/en/100", 0), ("http://blog.thation.example/es/5", 0),
    ("https://m.erthan.example/de/31", 0), ("http://www.onthes.example/fr/2.html", 0),
]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A to Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest ``(host, path, verdict)`` that fits: a struct of ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the path starts with its path. Rules are a
    short list; of two that fit and are equally long the one listed first wins.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of ``^host path$``, in lower case; a short text gives itself."""
    whole = F.concat(F.lit("^"), host, F.lit(" "), F.lower(path), F.lit("$"))

    def grams(s: Column, n: int) -> Column:
        last = F.greatest(F.length(s) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(s, i, F.lit(n)))

    return let(whole, lambda s: F.concat(*[grams(s, n) for n in sizes]))


def featured(df: DataFrame, host: str, path: str, buckets: int) -> DataFrame:
    grams = df.withColumn("_grams", ngrams(F.col(host), F.col(path)))
    return HashingTF(binary=True, numFeatures=buckets, inputCol="_grams",
                     outputCol="_features").transform(grams).drop("_grams")


def train(spark: SparkSession, labelled: Sequence[tuple[str, int]] = LABELLED, *,
          buckets: int = 1 << 14, penalty: float = 0.01) -> LogisticRegressionModel:
    """A model from a small table of ``(url, 1 if blocked)``, bounded by being a literal."""
    table = spark.createDataFrame(list(labelled), "url string, label double" if isinstance(
        labelled[0][1], float) else "url string, label int").coalesce(1)
    table = table.select(host(F.col("url")).alias("_host"), path(F.col("url")).alias("_path"),
                         F.col("label").cast("double").alias("_label"))
    return LogisticRegression(featuresCol="_features", labelCol="_label", regParam=penalty,
                              maxIter=60).fit(featured(table, "_host", "_path", buckets))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], model: LogisticRegressionModel, *,
          url: str = "url", id: str = "page_id", threshold: float = 0.5) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of every url.

    A null url and one without ``://`` have empty host and path and are judged by the model
    like any other. Repeated rows are judged alike; columns besides ``id`` and ``url`` are not
    looked at. ``score`` is the model's probability of block, also where a rule decides.
    """
    parts = pages.select(F.col(id).alias("_id"), host(F.col(url)).alias("_host"), path(F.col(url)).alias("_path"))
    scored = (model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
              .transform(featured(parts, "_host", "_path", model.numFeatures))
              .withColumn("_score", vector_to_array("_p")[1])
              .withColumn("_rule", rule_for(F.col("_host"), F.col("_path"), rules)))
    by_model = F.when(F.col("_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("_id").alias(id), F.col("_host").alias("host"), F.col("_path").alias("path"),
                         F.col("_rule.rule").alias("rule"),
                         F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict"),
                         F.col("_score").alias("score"))
