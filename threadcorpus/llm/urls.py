"""URL filters: a block and allow list, and gradient-boosted trees where no rule fits.

The trees learn from the URLs that the list judges, on lexical features only:
length, depth, digit share, entropy, parameter counts and what share of the
listed URLs with the same host suffix is blocked. DataFrame functions and
Spark's own boosted trees do all the work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.operators.joins import checked_join
from threadcorpus.session import materialize


@dataclass(frozen=True)
class Rule:
    """A rule for a host, all its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
# Listed URLs that the trees are fitted on: at most so many, the first by a hash.
FIT_ROWS = 20_000
TREES, DEPTH, BINS = 20, 3, 32
BLOCK_SCORE = 0.5
# A suffix without listed URLs has the share of all; this many URLs weigh as much as that share.
SUFFIX_PRIOR = 10.0
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "hyphens", "entropy",
            "n_params", "query_length", "has_fragment", "suffix_length", "suffix_blocked", "suffix_share")


def parts(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``; both are empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    lower = F.translate(F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1),
                        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", url.alias("url"), rest.alias("rest")).select(
        "page_id", "url", lower.alias("host"), F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))


def listed(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits host and path, or null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit(f".{r.host}"))) & F.startswith("path", F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _share(of: Column, pattern: str) -> Column:
    return F.when(F.length(of) > 0, F.regexp_count(of, F.lit(pattern)) / F.length(of)).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    n = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: F.when(F.length(c) > 0, (n - F.length(F.replace(text, c, F.lit("")))) / n))
    return F.when(n > 0, -F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.coalesce(p * F.log2(p), F.lit(0.0)))
                  ).otherwise(F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` with the lexical features and the host's suffix (its last label)."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    suffix = F.element_at(F.split(host, r"\."), -1)
    return urls.select(
        "*", F.length(url).alias("length"), F.length(host).alias("host_length"), F.length(path).alias("path_length"),
        F.regexp_count(path, F.lit("/[^/]")).alias("depth"), F.regexp_count(host, F.lit(r"\.")).alias("labels"),
        _share(url, "[0-9]").alias("digits"), F.regexp_count(url, F.lit("-")).alias("hyphens"),
        _entropy(url).alias("entropy"),
        F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(F.lit(0)).alias("n_params"),
        F.length(query).alias("query_length"), F.contains(url, F.lit("#")).cast("int").alias("has_fragment"),
        F.length(suffix).alias("suffix_length"), suffix.alias("suffix"))


def with_suffixes(urls: DataFrame) -> tuple[DataFrame, int, int]:
    """``urls`` with the statistics of their suffix over all listed URLs, and the numbers of listed and of blocked ones.

    ``suffix_blocked`` is the share of block verdicts of that very suffix, drawn
    towards the share of all by ``SUFFIX_PRIOR``; ``suffix_share`` the suffix's
    share of the listed URLs, 0 where it has none.
    """
    stats = materialize(urls.where("bad is not null").groupBy("suffix").agg(F.count("*").alias("n_listed"), F.sum("bad").alias("n_bad")))
    total = stats.agg(F.coalesce(F.sum("n_listed"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_bad"), F.lit(0)).alias("bad")).first()
    n, bad = total["n"], total["bad"]
    count, blocked = F.coalesce("n_listed", F.lit(0)), F.coalesce("n_bad", F.lit(0))
    out = checked_join(urls, stats, "suffix", "left").withColumns({
        "suffix_blocked": (blocked + SUFFIX_PRIOR * (bad / n if n else 0.0)) / (count + SUFFIX_PRIOR),
        "suffix_share": count / F.lit(float(max(n, 1)))})
    return out.drop("n_listed", "n_bad"), n, bad


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row.

    ``score`` is the trees' chance of "block"; it decides where no rule fits.
    When the listed URLs are all of one verdict, or there are none, no trees
    can be fitted: the score is their share of "block" (0 without any). A null
    url has empty parts and no rule; repeated rows are judged alike; an empty
    table gives no rows; other columns are ignored.
    """
    name, verdict = listed(rules)
    urls = materialize(lexical(parts(pages).withColumns({"rule": name, "listed": verdict}))
                       .withColumn("bad", (F.col("listed") == "block").cast("int")))
    urls, n, bad = with_suffixes(urls)
    prior = bad / n if n else 0.0
    if not 0 < bad < n:
        scored = urls.withColumn("score", F.lit(float(prior)))
    else:
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(urls)
        sample = rows.where("bad is not null").select("features", F.col("bad").cast("double").alias("label"), "url", "page_id")
        sample = sample.orderBy(F.xxhash64("url"), "url", "page_id").limit(fit_rows).select("features", "label")
        gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=1, stepSize=0.3, cacheNodeIds=False)
        model = gbt.fit(materialize(sample))
        scored = model.transform(rows).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    by_score = F.when(F.col("score") >= BLOCK_SCORE, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("listed", by_score).alias("verdict"), "score")
