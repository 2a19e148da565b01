"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds are found by pattern. Beyond them, long mixed tokens are
candidates. The hashes of all found values are counted over the whole corpus
by distinct repositories (documents) and owners (sources): a value that many
owners share is a copied example, a value of one owner only looks like a live
credential, however many repositories of that owner hold it. Candidates of
the latter sort become spans of kind ``owned``; the number of repositories is
reported beside, as how far a value has spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import text_of
from threadcorpus.operators.joins import checked_join
from threadcorpus.session import materialize

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# As `AKIA[A-Z0-9]+` of 20 characters or more and `[0-9a-f]+` of 24 or more: a
# shorter match holds no longer one, so the bound can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OWNED = r"[A-Za-z0-9+/_-]{20,}"
ASSIGN_MIN = 6
KINDS = ("assign", "access", "hex", "owned")
# A value of so many owners or more is an example; one of a single owner, with
# so many bits of entropy a character, is live.
EXAMPLE_OWNERS = 3
LIVE_ENTROPY = 3.0

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _entropy(value: Column) -> Column:
    """Shannon entropy of a string's characters, in bits."""
    n = F.length(value)
    chars = F.array_distinct(F.split(value, ""))
    return -F.aggregate(F.transform(chars, lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n),
                        F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _found(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Spans of a pattern's matches: the lengths of matches and of the pieces between give the places."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else whole
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(pieces, 1, F.size(whole)), whole,
                       lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, x):
        a = acc["at"] + x["gap"]
        return F.struct((a + x["size"]).alias("at"),
                        F.concat(acc["spans"], F.array(F.struct(a.alias("start"), (a + x["size"]).alias("end"))))
                        .alias("spans"))

    places = F.aggregate(steps, start, step, lambda acc: acc["spans"])
    spans = F.zip_with(places, value, lambda p, v: F.struct(
        p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end"), v.alias("value")))
    if least:
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, repository, owner, row, base, more``: base spans and further candidates of every row."""
    text = F.col("text")
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("repository"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("owner"),
                       F.monotonically_increasing_id().alias("row"), text_of().alias("text"))
    access = F.when(F.contains(text, F.lit("AKIA")), _found(text, ACCESS, 1)).otherwise(F.array().cast(_SPAN))
    spans = rows.select(
        "doc_id", "repository", "owner", "row",
        F.array_sort(F.concat(_found(text, ASSIGN, 0, ASSIGN_MIN), access, _found(text, HEX, 2))).alias("base"),
        _found(text, OWNED, 3).alias("more"))

    def free(s):
        mixed = s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
        return mixed & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    return spans.withColumn("more", F.filter("more", free))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans, n_live, n_example, max_owners, max_repositories`` of every row.

    ``base`` are the spans of the base kinds, ``spans`` these and the owned
    ones, both sorted by start, then kind; ends are exclusive, in code
    points. ``max_owners`` and ``max_repositories`` are those of the row's most
    widely held value, 0 without values. ``source`` names the owner, ``doc_id``
    the repository. A null source is one owner, a null doc_id one repository of
    its owner, a null text is empty; a repeated row is searched again; an empty table gives no
    rows; other columns are ignored.
    """
    found = materialize(find(docs))
    values = found.select("repository", "owner", "row", F.explode(F.concat("base", "more")).alias("s"))
    values = values.select("repository", "owner", "row", "s", F.sha2(F.col("s.value"), 256).alias("hash"))
    # Distinct (value, owner, repository), then by owner, then by value: a value that everyone copies is
    # spread by its repositories and summed before it is shuffled by itself.
    by_owner = values.select("hash", "owner", "repository").distinct().groupBy("hash", "owner").agg(F.count("*").alias("n"))
    counts = materialize(by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")))
    judged = checked_join(values.drop("repository", "owner"), counts, "hash")
    live = (F.col("n_owners") == 1) & (_entropy(F.col("s.value")) >= LIVE_ENTROPY)
    per_row = judged.withColumn("live", live).groupBy("row").agg(
        F.collect_list(F.when((F.col("s.kind") == 3) & F.col("live"), F.col("s"))).alias("owned"),
        F.count_if("live").alias("n_live"), F.count_if(F.col("n_owners") >= EXAMPLE_OWNERS).alias("n_example"),
        F.max("n_owners").alias("max_owners"), F.max("n_repositories").alias("max_repositories"))
    joined = found.join(per_row, "row", "left")
    owned = F.coalesce("owned", F.array().cast(_SPAN))
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", owned)).alias("spans"),
                         *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                           for c in ("n_live", "n_example", "max_owners", "max_repositories")])


def _joined(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")

    return scanned.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                          F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
                          "n_live", "n_example", "max_owners", "max_repositories")
