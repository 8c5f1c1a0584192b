"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

A rule fits its host and all subdomains if the URL's path starts with the rule's path; the longest rule that fits decides. For
the rest, the characters of host and path (each between marks) are cut into n-grams, hashed into a fixed number of features,
and weighed by a logistic regression that is trained from a small labelled table of URLs. All of it are DataFrame operations and
Spark ML's transformers, which run in the JVM; judging is a map over rows.

Defined results: a NULL url, or one without ://, has an empty host and path, fits no rule and is judged by the model like any
other. Repeated rows are judged each. URLs are read whole, whatever their length. At even odds the verdict is allow. If rules of
one length fit, the first by name decides. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.common import ascii_lower, let

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


@dataclass(frozen=True)
class Settings:
    """sizes: lengths of n-grams; features: size of the hashed space; max_training_rows: bound of the labelled table."""

    sizes: tuple[int, ...] = (3, 4, 5)
    features: int = 1 << 16
    regularisation: float = 0.003
    iterations: int = 60
    max_training_rows: int = 10_000


#: The small labelled table: words of host names and paths that say what a site is for.
UNWANTED = (
    "www.spam-farm.com/en/4", "seo-spam.net/buy", "link-farm.org/links/", "blog.casino-win.com/de/7", "online-casino.net/play", "royal-casino.org/fr/bonus",
    "adult-x.com/en/12", "adult-video.net/watch", "m.xxx-adult.org/clips", "cheap-pills.com/es/31", "pills-online.net/order", "discount-pills.org/en/9/",
    "free-bets.com/en/28", "sports-bets.net/odds", "best-bets.org/fr/free", "m.ads-track.com/de/3", "click-track.net/pixel", "ads-serve.org/banner",
    "win-prize-now.com/en/1", "poker-win.net/play", "cheap-loans.org/apply", "free-money.net/win", "track-click.org/ads", "www.hot-adult-x.net/es/5",
)
WANTED = (
    "library.edu/en/books/10", "www.wiki.org/de/artikel/12", "news.com/fr/2020/05/12", "university.edu/es/725", "blog.science.net/en/88", "m.weather.com/en/city/5",
    "www.museum.org/fr/expo/31", "docs.software.org/en/manual.html", "blog.garden.com/de/411/", "www.history.net/es/1810.html", "journal.org/en/44?page=2", "school.com/fr/cours/7",
    "m.radio.net/de/sendung/9", "mountain.org/en/5", "health.gov/en/advice/12", "www.cooking.com/es/recetas/80", "blog.travel.net/fr/97#top", "city.example/en/25930/",
    "painting.com/en/7198", "theatre.org/de/39547.html", "station.net/es/26123", "weather.com/fr/34463", "river.org/en/12213", "m.nature.net/de/12440",
    "blog.theory.com/en/3", "bread.net/de/88.html", "www.ocean.com/es/14", "m.street.org/fr/206/", "letters.com/en/7", "another.org/es/31",
    "blog.heritage.net/en/1990", "shelter.com/de/17", "www.thread.org/en/2", "reading.com/fr/9", "history-of-art.org/en/15", "well-being.net/de/4",
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """rule (host and path in one) and verdict of the longest rule that fits, or NULL."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    listed = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    made = F.array(*[F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in listed])
    fits = F.filter(made, lambda r: ((host == r.host) | F.endswith(host, F.concat(F.lit("."), r.host))) & F.startswith(path, r.path))
    first = F.get(fits, 0)
    return F.when(first.isNotNull(), F.struct(F.concat(first.host, first.path).alias("rule"), first.verdict.alias("verdict")))


def ngrams(text: Column, sizes: tuple[int, ...]) -> Column:
    """All n-grams of a text, repeats included."""

    def of_size(n: int):
        return lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - (n - 1), F.lit(1))), lambda i: F.substr(t, i, F.lit(n)))

    return F.concat(*[let(text, of_size(n)) for n in sizes])


def _featured(urls: DataFrame, settings: Settings) -> DataFrame:
    marked = F.concat(F.lit("^"), F.col("host"), F.lit("$"), F.col("path"), F.lit("$"))
    return HashingTF(numFeatures=settings.features, binary=True, inputCol="grams", outputCol="features").transform(urls.withColumn("grams", ngrams(marked, settings.sizes)))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label (1: block): the small labelled table."""
    return spark.createDataFrame([(f"https://{u}", 1.0) for u in UNWANTED] + [(f"https://{u}", 0.0) for u in WANTED], "url string, label double")


def train(labelled: DataFrame, settings: Settings = Settings()) -> LogisticRegressionModel:
    """labelled: url, label. At most max_training_rows of its rows are used, those with the smallest hashes."""
    host, path = parts(F.col("url"))
    rows = labelled.select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"), "url").orderBy(F.xxhash64("url"), "url").limit(settings.max_training_rows)
    return LogisticRegression(maxIter=settings.iterations, regParam=settings.regularisation, standardization=False).fit(_featured(rows, settings).coalesce(1))


def judge(pages: DataFrame, rules: list[Rule], model: LogisticRegressionModel, settings: Settings = Settings(), id_cols: list[str] = ["page_id"], url: str = "url") -> DataFrame:
    """id_cols, host, path, rule, verdict, score (the model's probability of block): a row for each row of pages."""
    host, path = parts(F.col(url))
    rows = pages.select(*id_cols, host.alias("host"), path.alias("path"))
    scored = model.transform(_featured(rows, settings)).withColumn("decision", deciding_rule(F.col("host"), F.col("path"), rules))
    modelled = F.when(F.col("prediction") == 1, BLOCK).otherwise(ALLOW)
    return scored.select(*id_cols, "host", "path", F.col("decision.rule").alias("rule"), F.coalesce("decision.verdict", modelled).alias("verdict"), F.get(vector_to_array("probability"), F.lit(1)).alias("score"))
