"""Address filter: explicit rules first, empirical-Bayes host reputation for the rest.

A rule names a host and a path; it fits that host and its subdomains where the address's path
starts with the rule's, and the longest fitting rule decides. Pages that a rule decides are
labelled outcomes, blocked being bad, and so are the rows of an optional table of labelled
addresses; from these the hosts of all other pages are judged.

Outcomes are counted for each host and summed up to its registered domain and its suffix. Going
down again, a level's bad rates are drawn from a beta distribution around the parent's mean: how
far rates of siblings differ beyond chance gives, by moments, the level's intra-class correlation
and from it how many pages the parent's opinion is worth, at most those that the parent's own
posterior is made of. A node's posterior is that prior plus its own outcomes, so a host with few labelled pages says what its domain says, and a domain
without any what its suffix says. A page is blocked if the lower bound of its host's posterior bad
rate lies above a threshold; the bound is Cantelli's, which holds for every distribution.

Defined cases: a null address, or one without "://", has an empty host and path and is judged as
the host "", whose suffix and domain are empty too; address literals and one-label hosts
are their own domain; without outcomes every rate is the uniform prior's and nothing is blocked;
repeated rows are counted and judged each; of rules equal in length the longer host wins, of
equal rules blocking; no pages give no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import salted_join, written

# Suffixes of two labels under which domains are registered.
SUFFIXES = (
    "ac.uk co.uk gov.uk ltd.uk me.uk net.uk nhs.uk org.uk plc.uk sch.uk asn.au com.au edu.au gov.au id.au net.au org.au "
    "ac.jp co.jp go.jp ne.jp or.jp ac.nz co.nz govt.nz net.nz org.nz ac.za co.za com.br gov.br net.br org.br com.cn edu.cn "
    "gov.cn net.cn org.cn ac.in co.in gov.in net.in org.in ac.kr co.kr go.kr or.kr com.mx com.tr edu.tr com.ar com.tw com.hk com.sg"
).split()
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THRESHOLD = 0.5
DOUBT = 0.05
LEAST_CORRELATION = 0.001
MOST_CORRELATION = 0.5


def host_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of an address; both empty without a "://"."""
    place = F.locate("://", F.col(url))
    rest = F.when(place > 0, F.substring(F.col(url), place + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWERED), F.lit("")), F.coalesce(path, F.lit(""))


def domain_suffix(host: str, suffixes: list[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user and port."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    literal = name.rlike(r"^[0-9.]+$|^\[")
    last, two = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    wide = two.isin(suffixes)
    domain = F.when(literal, name).when(wide, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, F.when(literal, F.lit("")).when(wide, two).otherwise(last)


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, rule_host, rule_path, blocks) from pairs of a verdict and host/path."""
    rows = [(rule, rule.partition("/")[0], rule[rule.index("/") :], verdict == "block") for verdict, rule in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, blocks boolean")


def ruled(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(_row, rule, blocks) of the rows with _row, host and path that some rule fits.

    An address has one candidate for each pair of label count and path length that rules have, and
    candidates meet rules by equality, however many rules there are.
    """
    strict = rules.groupBy("rule", "rule_host", "rule_path").agg(F.bool_or("blocks").alias("blocks"))
    labels = (F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."))) + 1).cast("int")
    shapes = sorted(tuple(r) for r in strict.select(labels, F.length("rule_path")).distinct().collect())
    if not shapes:
        return pages.select("_row", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("boolean").alias("blocks")).where("false")
    candidates = F.array(*[F.struct(F.substring_index("host", ".", -n).alias("rule_host"), F.substring("path", 1, size).alias("rule_path")) for n, size in shapes])
    met = salted_join(pages.select("_row", F.inline(candidates)), strict, ["rule_host", "rule_path"], "_row", "inner")
    best = F.max(F.struct(F.length("rule").alias("size"), F.length(F.substring_index("rule", "/", 1)).alias("host"), "rule", "blocks"))
    return met.groupBy("_row").agg(best.alias("best")).select("_row", "best.rule", "best.blocks")


def _correlation(nodes: DataFrame) -> float:
    """How alike outcomes within a node are: n * (rate - mean)^2 / (mean * (1 - mean)) is 1 + (n - 1) * correlation on average."""
    m = F.col("prior_mean")
    miss = F.col("n") * F.pow(F.col("bad") / F.col("n") - m, 2) / (m * (1 - m))
    found = nodes.where("n > 0").agg(F.try_divide(F.sum(miss) - F.count("*"), F.sum("n") - F.count("*"))).first()[0]
    return min(max(found or 0.0, LEAST_CORRELATION), MOST_CORRELATION)


def _posterior(nodes: DataFrame) -> DataFrame:
    """Adds alpha, beta and mean of the posterior to nodes with n, bad, prior_mean and prior_size."""
    worth = F.least(F.lit(1 / _correlation(nodes) - 1), F.col("prior_size"))
    alpha = worth * F.col("prior_mean") + F.col("bad")
    beta = worth * (1 - F.col("prior_mean")) + F.col("n") - F.col("bad")
    return nodes.withColumn("alpha", alpha).withColumn("beta", beta).withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def reputations(outcomes: DataFrame, suffixes: list[str] = SUFFIXES, doubt: float = DOUBT) -> DataFrame:
    """(host, n, bad, mean, bound) of every host of rows (host, bad), of which bad is 1, 0 or null for unlabelled.

    A host's rows are counted before they move; a domain that holds a third of the hosts is salted.
    """
    domain, suffix = domain_suffix("host", suffixes)
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    hosts = written(counts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")

    def summed(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    # Above the suffixes stands a uniform prior with all outcomes.
    root = [F.lit((total[1] + 1.0) / (total[0] + 2.0)).alias("prior_mean"), F.lit(total[0] + 2.0).alias("prior_size")]
    top = _posterior(written(summed("suffix").select("*", *root), "suffixes", slim=True))
    prior = [F.col("mean").alias("prior_mean"), (F.col("alpha") + F.col("beta")).alias("prior_size")]
    parents = top.select("suffix", *prior)
    middle = _posterior(written(salted_join(summed("domain", "suffix"), parents, ["suffix"], "domain", "inner"), "domains", slim=True))
    parents = middle.select("domain", "suffix", *prior)
    judged = _posterior(written(salted_join(hosts, parents, ["domain", "suffix"], "host", "inner"), "host-priors", slim=True))
    a, b = F.col("alpha"), F.col("beta")
    deviation = F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    reach = ((1 - doubt) / doubt) ** 0.5
    return judged.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(reach) * deviation).alias("bound"))


def url_filter(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    outcomes: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    threshold: float = THRESHOLD,
    doubt: float = DOUBT,
    suffixes: list[str] = SUFFIXES,
) -> DataFrame:
    """One row a page: page_id, host, path, the rule that decides it or null, verdict, and its host's bad rate and bound.

    ``outcomes`` may add labelled addresses (url, bad: 1, 0 or null) to those that rules decide.
    """
    host, path = host_path(url)
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "addresses")
    decided = ruled(rows, rule_table(pages.sparkSession, rules))
    rows = written(rows.join(decided, "_row", "left"), "ruled")
    seen = rows.select("host", F.col("blocks").cast("int").alias("bad"))
    if outcomes is not None:
        seen = seen.unionByName(outcomes.select(host_path("url")[0].alias("host"), F.col("bad").cast("int").alias("bad")))
    known = reputations(seen, suffixes, doubt)
    judged = salted_join(rows, known.select("host", F.col("mean").alias("bad_rate"), "bound"), ["host"], "_row")
    blocked = F.coalesce("blocks", F.col("bound") > threshold)
    return judged.select("page_id", "host", "path", "rule", F.when(blocked, "block").otherwise("allow").alias("verdict"), "bad_rate", "bound")
