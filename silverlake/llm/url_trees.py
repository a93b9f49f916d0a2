"""URL verdicts by rules, and by gradient-boosted trees where no rule fits.

URLs that a rule covers are the labelled ones. Trees are trained on lexical features of these: length,
depth, digit ratio, entropy of the characters, hyphens, labels of the host, parameters, and suffix
statistics, the smoothed share of blocked URLs among those labelled with the same top-level domain, the
same last two host labels, and the same first path segment. A row that is trained on has the shares of the other
``FOLDS`` - 1 parts of the URLs, as its own part's would tell its label. Features are DataFrame expressions; the trees
are MLlib's, trained on at most ``MOST_ROWS`` labelled URLs picked by a hash; statistics cover all of them.

A rule is a host and a path: it fits the host itself and its subdomains if the path starts with the
rule's, and the longest rule wins. Rules are a list in the program, so their number is bounded.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged by
the trees like any other; a host is lower-cased in A-Z only; repeated rows are judged one by one; if the
labelled URLs are all of one verdict, or there are none, the trees are left out and the verdict is that one
(allow, if there are none); an empty table gives an empty result; only the id and the URL are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table

MOST_ROWS = 50_000
TREES, DEPTH, SEED = 20, 4, 7
SMOOTH, FOLDS = 10.0, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    at = text.index("/")
    return Rule(verdict, text[:at], text[at:])


RULES = (
    rule("allow", "org/"),
    rule("block", "example.org/es/"),
    rule("block", "example.org/en/1"),
    rule("allow", "com/fr/"),
    rule("block", "com/de/"),
)
PLAIN = ("length", "host_length", "path_length", "depth", "labels", "digits", "hyphens", "parameters", "entropy")
SUFFIXES = ("tld", "domain", "segment")


def parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url (null: empty), host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return pages.select(
        F.col(id_col).alias("page_id"),
        url.alias("url"),
        F.translate(host, UPPER, LOWER).alias("host"),
        F.regexp_extract(after, r"^([^?#]*)", 1).alias("path"),
    )


def fits(one: Rule) -> Column:
    host = F.col("host")
    return ((host == one.host) | host.endswith(f".{one.host}")) & F.col("path").startswith(one.path)


def by_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``rule`` (its text) and ``marked`` (its verdict), both null where none fits."""
    found, marked = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: (len(r.text), r.text)):
        found = F.when(fits(one), one.text).otherwise(found)
        marked = F.when(fits(one), one.verdict).otherwise(marked)
    return pages.select("*", found.alias("rule"), marked.alias("marked"))


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the lexical features and the keys of the suffix statistics."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    chars = F.array_distinct(F.split(url, ""))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c))) / F.length(url)
    entropy = F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c))
    )
    count = lambda pattern: F.regexp_count(url, F.lit(pattern)).cast("double")
    return pages.select(
        "*",
        F.length(url).cast("double").alias("length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        F.regexp_count(path, F.lit(r"[^/]+")).cast("double").alias("depth"),
        F.regexp_count(host, F.lit(r"[^.]+")).cast("double").alias("labels"),
        (count("[0-9]") / F.greatest(F.length(url), F.lit(1))).alias("digits"),
        count("-").alias("hyphens"),
        count("[?&][^?&=#]+=").alias("parameters"),
        entropy.alias("entropy"),
        F.regexp_extract(host, r"([^.]*)$", 1).alias("tld"),
        F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1).alias("domain"),
        F.regexp_extract(path, r"^/([^/]*)", 1).alias("segment"),
    )


def fold() -> Column:
    """A part of the URLs, by a hash, so that rows which repeat one are in the same."""
    return F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS))


@dataclass(frozen=True)
class Trees:
    """The suffix statistics by kind (labelled and blocked URLs in each fold), the share of blocked URLs, and the
    trees (None: one verdict only)."""

    stats: dict[str, DataFrame]
    prior: float
    model: GBTClassificationModel | None

    def features(self, pages: DataFrame, learning: bool = False) -> DataFrame:
        """``learning``: the rows are in the statistics, and those of a row's own fold are left out of its rates."""
        rows = pages.withColumn("fold", fold()) if learning else pages
        for kind in SUFFIXES:
            stats = self.stats[kind]
            whole = stats.groupBy(kind).agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
            rows = rows.join(whole, kind, "left")
            blocked, n = F.coalesce("blocked", F.lit(0.0)), F.coalesce("n", F.lit(0))
            if learning:
                own = stats.select(kind, "fold", F.col("blocked").alias("own_blocked"), F.col("n").alias("own_n"))
                rows = rows.join(own, [kind, "fold"], "left")
                blocked, n = blocked - F.coalesce("own_blocked", F.lit(0.0)), n - F.coalesce("own_n", F.lit(0))
            rate = (blocked + SMOOTH * self.prior) / (n + SMOOTH)
            rows = rows.withColumn(f"{kind}_rate", rate).drop("blocked", "n", "own_blocked", "own_n")
        columns = [*PLAIN, *(f"{kind}_rate" for kind in SUFFIXES)]
        return VectorAssembler(inputCols=columns, outputCol="features").transform(rows)

    def judge(self, pages: DataFrame) -> DataFrame:
        """Adds ``score``, the probability of block, to the output of ``lexical``."""
        if self.model is None:
            return pages.withColumn("score", F.lit(self.prior))
        scored = self.model.transform(self.features(pages))
        return scored.withColumn("score", vector_to_array("probability")[1])


def train(marked: DataFrame, most: int = MOST_ROWS, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """From the output of ``lexical`` over labelled pages: column ``marked`` is allow or block."""
    labelled = marked.where("marked is not null").withColumn("label", (F.col("marked") == "block").cast("double"))
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).first()
    prior = counts["blocked"] / counts["n"] if counts["n"] else 0.0
    stats = {}
    for kind in SUFFIXES:
        sums = F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n")
        stats[kind] = stored(labelled.groupBy(kind, fold().alias("fold")).agg(*sums), f"url-{kind}")
    if prior in (0.0, 1.0):
        return Trees(stats, prior, None)
    sample = labelled.orderBy(F.xxhash64("url"), "url").limit(most)
    rows = stored(Trees(stats, prior, None).features(sample, learning=True).select("features", "label"), "url-train")
    booster = GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED, stepSize=0.2)
    return Trees(stats, prior, booster.fit(rows))


def verdicts(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    most: int = MOST_ROWS,
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' probability of block, null where a rule decides)."""
    rows = stored(lexical(by_rules(parts(pages, id_col, url_col), rules)), "urls")
    # Only what no rule decides is joined with the statistics and judged.
    judged = train(rows, most).judge(rows.where("marked is null"))
    decided = rows.where("marked is not null").withColumn("score", F.lit(None).cast("double"))
    wanted = ["page_id", "host", "path", "rule", "marked", "score"]
    by_trees = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.select(*wanted).unionByName(decided.select(*wanted)).select(
        "page_id", "host", "path", "rule", F.coalesce("marked", by_trees).alias("verdict"), "score"
    )


def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"))
