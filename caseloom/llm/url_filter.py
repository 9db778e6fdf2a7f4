"""URL verdicts: longest rule, else boosted trees on lexical features.

URLs that a rule decides are the labelled ones. From them boosted trees learn which form blocked
addresses have: lengths, depth, digits, entropy, parameters and, per host suffix, the share of
blocked ones. The shares are counted over all labelled URLs; only the trees are fitted on a bounded
sample (``TRAIN_ROWS``). They judge the URLs without a rule.

Suffixes with ``SUFFIX_ROWS`` labelled URLs have a share, so their table grows with the input: it is
stored, and broadcast only if its measured size is small enough for the session.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and
is judged by its features (all 0 for null); repeated rows are judged alike; without labelled URLs
the verdict is allow, with labels of one kind it is that kind. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tables import ascii_lower, stored
from caseloom.operators.joins import lookup_join
from caseloom.session import scratch_path

#: Labelled URLs that the trees are fitted on, as an expected number.
TRAIN_ROWS = 20_000
#: Labelled URLs a host suffix must have to get a share of its own.
SUFFIX_ROWS = 5
_TREES = dict(maxIter=16, maxDepth=3, maxBins=32, stepSize=0.2, seed=7)


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains, ``path`` is a prefix of the URL's path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3,
                                                       F.char_length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(ascii_lower(host), empty), F.coalesce(path, empty)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"),
                                      F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, of: str) -> Column:
    return F.regexp_count(text, F.lit(of))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers that describe the form of a URL. Every value is finite."""
    text = F.coalesce(url, F.lit(""))
    length = F.char_length(text)
    some = F.greatest(length, F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    share = lambda c: (length - F.char_length(F.replace(text, c, F.lit("")))) / some
    entropy = -F.aggregate(
        F.filter(F.array_distinct(F.split(text, "")), lambda c: c != ""), F.lit(0.0),
        lambda sum_, c: sum_ + share(c) * F.log2(F.greatest(share(c), F.lit(1e-12))))
    parameters = F.when(query == "", 0).otherwise(_count(query, "[&;]") + 1)
    features = {
        "length": length, "host_length": F.char_length(host), "path_length": F.char_length(path),
        "depth": _count(path, "/[^/]"), "labels": _count(host, "[^.]+"),
        "digit_ratio": _count(text, "[0-9]") / some, "host_digits": _count(host, "[0-9]"),
        "hyphens": _count(host, "-"), "escapes": _count(text, "%"), "entropy": entropy,
        "parameters": parameters, "secure": text.startswith("https:"),
    }
    return {name: value.cast("double") for name, value in features.items()}


def _suffixes(host: Column) -> tuple[Column, Column]:
    return (F.regexp_extract(host, r"([^.]*)$", 1),
            F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1))


def suffix_shares(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored shares of blocked rows by last label (tld) and by last two labels (site) of the host,
    over all rows of ``labelled`` (tld, site, label)."""
    suffixes = F.explode(F.array_distinct(F.array("tld", "site"))).alias("suffix")
    shares = stored(labelled.select(suffixes, "label").groupBy("suffix").agg(
        ((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias("share"),
        F.count(F.lit(1)).alias("n"),
    ).filter(F.col("n") >= SUFFIX_ROWS).select("suffix", "share"), "url-shares")
    dotted = F.instr("suffix", ".") > 0
    return tuple(
        stored(shares.filter(holds).select(F.col("suffix").alias(name),
                                           F.col("share").alias(f"{name}_share")), f"url-{name}")
        for name, holds in (("tld", ~dotted), ("site", dotted | (F.col("suffix") == ""))))


def _with_shares(rows: DataFrame, shares: tuple[DataFrame, DataFrame]) -> DataFrame:
    for suffix, one in zip(("tld", "site"), shares):
        rows = lookup_join(rows, one, suffix).fillna(0.5, [f"{suffix}_share"])
    return rows


def judge_urls(pages: DataFrame, rules: list[Rule], identifier: str = "page_id",
               url: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and ``block_score`` (null where a rule decides)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(identifier).alias("page_id"), F.col(url).alias("url"))
    host, path = split_url(F.col("url"))
    split = rows.withColumn("host", host).withColumn("path", path)
    found = split.withColumn("found", longest_rule(rules, F.col("host"), F.col("path")))
    tld, site = _suffixes(F.col("host"))
    names = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    described = found.select("page_id", "host", "path", "found", "url", tld.alias("tld"),
                             site.alias("site"))

    labelled = described.filter("found is not null").withColumn(
        "label", (F.col("found.verdict") == "block").cast("double"))
    kinds = {r["verdict"]: r["n"] for r in labelled.groupBy(F.col("found.verdict")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        verdict = next(iter(kinds), "allow")
        return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                            F.coalesce("found.verdict", F.lit(verdict)).alias("verdict"),
                            F.lit(None).cast("double").alias("block_score"))

    # An expected number of rows, drawn by a hash of the URL; one file, as it is bounded.
    drawn = F.pmod(F.xxhash64(F.lit(11), "url", "page_id"), F.lit(1 << 30)) \
        < F.lit(int(min(1.0, train_rows / total) * (1 << 30)))
    path_of = scratch_path(spark, "url-sample")
    labelled.filter(drawn).drop("found").repartition(1).write.parquet(path_of)
    shares = suffix_shares(labelled)
    features = [*names, "tld_share", "site_share"]
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    prepare = lambda part: assembler.transform(_with_shares(part, shares).withColumns(names))
    training = stored(prepare(spark.read.parquet(path_of)).select("features", "label"), "url-train")
    model: GBTClassificationModel = GBTClassifier(**_TREES).fit(training)
    scored = model.transform(prepare(described)).withColumn(
        "score", vector_to_array("probability")[1])
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
        .alias("verdict"),
        F.when(F.col("found").isNull(), F.col("score")).alias("block_score"),
    )
