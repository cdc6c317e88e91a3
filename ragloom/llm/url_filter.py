"""URL filter: longest host and path rule, else logistic regression.

Urls that no rule fits are judged by a logistic regression on hashed character
n-grams of host and path, fitted to a small labelled table of urls. All steps
are column expressions and Spark's own model classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 16

# Fixed values: (verdict, host, path) of the url rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# The labelled table is made of these words by rule (:func:`labelled_urls`):
# words of sites to block, and of sites to allow.
BLOCKED_WORDS = """
adult ads affiliate bet bets betting bingo bonus cam cams cash casino cheap claim click clicks clone coupon crack cracked credit crypto dating debt deal
diet discount dose drugs earn escort farm fast followers forex free gambling gift giveaway hack hot instant jackpot keygen
likes link links loan loans lottery lotto lucky meds miracle money nude offer offers online payday pharma pharmacy phish pill pills poker popup porn
prize profit promo replica rich scam seo sex sexy singles slots spam spin stream sweepstakes tracker track traffic viagra warez watches
webcam weightloss win winner xxx
""".split()
ALLOWED_WORDS = """
academy air anatomy animal archive art atlas author autumn baker bank bay bird blog board book books botany bread bridge build cable camera canal
castle cat center chemistry choir church cinema citizen city clay clinic coast code coffee college community cooking council county course craft culture
data design dentist developer dictionary docs earth east economics editor education energy engine english essay ethics events family field film
forest forum garden gazette geology german glass global grammar green guide harbor hat health herald hill history home horse hospital house
in inn institute island journal kitchen lab lake language law learn leather letter library light local magazine maker map market math
media medicine mill mind monitor motion mountain museum music nation nature network news north notes nurse ocean office opera orchard other our
paper parent park pen people physics piano planet poem poet portal press project public radio rail rain reader recipe research review river road
school science sea shop sister society soil song south space sport staff station stone street student studio summer support teacher tech than that the
theatre theme then there thing this thread time tion town trade trail train travel tree union university village vision voice wall water weather west
wiki wind winter wood word work world writer yard
""".split()
_PREFIXES = "", "www.", "m.", "blog."
_ENDS = ".example.com", ".example.org"
_PATHS = "/en/{}", "/fr/{}", "/es/{}/", "/de/{}.html", "/en/{}?page=2", "/{}"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _ngrams(text: Column, tag: str, sizes: Sequence[int]) -> Column:
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    none = F.array().cast("array<string>")

    def grams(n: int) -> Column:
        # the function takes the place alone: a second parameter would be the index
        return F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.concat(F.lit(tag), F.substring(marked, i, F.lit(n))))

    return F.concat(*[F.when(F.length(marked) >= n, grams(n)).otherwise(none) for n in sizes])


def url_ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5), path_sizes: Sequence[int] = (3,)) -> Column:
    """Character n-grams of host and path, each with its part's tag."""
    return F.concat(_ngrams(host, "h:", sizes), _ngrams(path, "p:", path_sizes))


def _urls(words: Sequence[str], steps: Sequence[int]) -> list[str]:
    """Each word alone and joined with the word so many places on, under hosts
    and paths that take turns."""
    names = [*words, *(f"{w}-{words[(i + k) % len(words)]}" for k in steps for i, w in enumerate(words))]
    return [f"http://{_PREFIXES[i % 4]}{name}{_ENDS[i % 7 % 2]}{_PATHS[i % 5 if i % 3 else 5].format(i * 37 % 997)}" for i, name in enumerate(names)]


def labelled_rows() -> list[tuple[str, float]]:
    """The labelled table: urls to block (1) and to allow (0)."""
    return [(u, 1.0) for u in _urls(BLOCKED_WORDS, (5, 23, 41))] + [(u, 0.0) for u in _urls(ALLOWED_WORDS, (7, 61))]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """:func:`labelled_rows` as a table (url, label)."""
    def table(label: float) -> DataFrame:
        urls = " ".join(u for u, x in labelled_rows() if x == label)
        return spark.range(1).select(F.explode(F.split(F.lit(urls), " ")).alias("url"), F.lit(label).alias("label"))

    return table(1.0).unionAll(table(0.0))


def _features(df: DataFrame) -> DataFrame:
    grams = df.withColumn("_grams", url_ngrams(F.col("_host"), F.col("_path")))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_features").transform(grams)


def fit_urls(labelled: DataFrame, strength: float = 0.003):
    """The logistic regression, fitted to the labelled table (url, label 0/1).
    The table is small by contract; it is brought into one partition so that
    the fit does not depend on how it is spread."""
    host, path = url_parts(F.col("url"))
    rows = _features(labelled.select(host.alias("_host"), path.alias("_path"), F.col("label").cast("double").alias("_label")))
    return LogisticRegression(featuresCol="_features", labelCol="_label", regParam=strength, maxIter=100, tol=1e-9, standardization=False,
                              rawPredictionCol="_raw", probabilityCol="_prob", predictionCol="_pred").fit(rows.coalesce(1))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """Judge every url.

    Returns one row per input row: the id column, ``host``, ``path``, ``rule``
    (the longest that fits, as host and path; null without one), ``verdict``
    (allow or block: the rule's, else block from ``threshold`` on) and
    ``score`` (the model's probability of block, also where a rule decides). A
    rule fits its host and all subdomains if the url's path starts with the
    rule's; of two of equal length the first listed wins. A null url or one
    without ``://`` has an empty host and path and is judged by the model.
    Other columns are not read. Repeated rows stay; an empty table gives an
    empty one. A url of n characters has about 4 n n-grams, whatever its length.
    Nothing is shuffled.
    """
    model = fit_urls(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    host, path = url_parts(F.col("_url"))
    parts = pages.select(pages[id_col].alias("_id"), pages[url_col].alias("_url")).select("_id", host.alias("_host"), path.alias("_path"))
    scored = model.transform(_features(parts)).select("_id", "_host", "_path", vector_to_array("_prob")[1].alias("score"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    for what, name, start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("_host") == name) | F.col("_host").endswith("." + name)) & F.col("_path").startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return scored.select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
                         rule.alias("rule"), verdict.alias("verdict"), "score")
