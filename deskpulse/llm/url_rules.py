"""URL verdicts: given host rules, and rules mined from labelled URLs by FP-growth."""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from deskpulse.llm.common import checkpointed, column

# (verdict, host, path): the longest rule that fits decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.002
# A rule rests on so many labelled urls at least, however few there are in all.
MIN_URLS = 30
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.5
BAD = "label=bad"
RULE = "antecedent array<string>, confidence double, lift double, support double, key string"


def host_of(url):
    """After the first :// up to /, ?, # or end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url):
    """What follows the host, up to ?, # or end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host, path, rules=RULES):
    """The longest rule that fits, as struct (length, rule, verdict), or null.

    A rule fits its host and the subdomains of it if the path starts with its path. The
    list is a parameter of the job and becomes part of the expression; of equally long
    rules the one later in code points wins.
    """
    fitting = [
        F.when(
            ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start)),
            F.struct(
                F.lit(len(name) + len(start)).alias("length"),
                F.lit(name + start).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for verdict, name, start in rules
    ]
    return F.array_max(F.array(*fitting))


def tokens_of(url):
    """The tokens of a url: scheme, hosts, path words, parameter names, fragment."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    words = F.filter(F.split(path, r"[/\d]+"), lambda w: w != "")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    names = F.filter(F.split(query, "&"), lambda q: q != "")
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
            hosts,
            F.transform(words, lambda w: F.concat(F.lit("path="), w)),
            F.transform(names, lambda q: F.concat(F.lit("query="), F.substring_index(q, "=", 1))),
            F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(
                F.array().cast("array<string>")
            ),
        )
    )


def _tokenised(urls):
    """(url, tokens) of the urls that have ://."""
    found = urls.where(F.contains("url", F.lit("://")))
    return found.select("url", F.explode(F.array(tokens_of(F.col("url")))).alias("tokens"))


def mine_rules(
    labelled,
    min_support=MIN_SUPPORT,
    min_confidence=MIN_CONFIDENCE,
    min_lift=MIN_LIFT,
    min_urls=MIN_URLS,
):
    """Rules (antecedent, key, confidence, lift, support) that point to bad urls.

    ``labelled`` has ``url`` and ``bad``. All labelled urls are mined. Rules below the
    thresholds are pruned. ``key`` is the rarest token of a rule. How many rules there can be depends on
    the thresholds and on the tokens of a url, not on the number of urls. Without
    labelled urls there are no rules.
    """
    known = labelled.where("bad is not null")
    known = known.where(F.contains("url", F.lit("://")))
    items = known.select(
        F.when(F.col("bad"), F.array_append(tokens_of(F.col("url")), F.lit(BAD)))
        .otherwise(tokens_of(F.col("url")))
        .alias("items")
    )
    items = checkpointed(items)
    n = items.count()
    if n == 0:
        return labelled.sparkSession.createDataFrame([], RULE)
    support = min(1.0, max(min_support, min_urls / n))
    model = FPGrowth(minSupport=support, minConfidence=min_confidence).fit(items)
    rules = checkpointed(
        model.associationRules.where(
            (F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") >= min_lift)
        ).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support")
    )
    single = model.freqItemsets.where(F.size("items") == 1).select(
        F.element_at("items", 1).alias("token"), "freq"
    )
    keyed = (
        rules.select("*", F.explode("antecedent").alias("token"))
        .join(single, "token")
        .groupBy("antecedent", "confidence", "lift", "support")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    )
    return checkpointed(keyed)


def blocked_urls(urls, rules):
    """(url, confidence) of the urls that hold all tokens of some rule.

    Rules are posted under their rarest token; a url meets the postings of its tokens.
    """
    tokenised = _tokenised(urls.select("url").distinct())
    met = tokenised.select("url", "tokens", F.explode("tokens").alias("key")).join(rules, "key")
    holds = F.size(F.array_except("antecedent", "tokens")) == 0
    return met.where(holds).groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages, labelled, id_col="page_id", url_col="url", rules=RULES, **thresholds):
    """Per page: ``host``, ``path``, ``rule`` (or null), ``verdict``.

    A given rule that fits decides; else a url is blocked if a mined rule points to it,
    and allowed if not. Null urls and those without :// have empty host and path, fit no
    rule and are allowed. Repeated rows are judged alike, each on its own.
    """
    mined = mine_rules(labelled, **thresholds)
    source = pages.select(column(id_col).alias("id"), column(url_col).alias("url"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bad = blocked_urls(source, mined).repartition(parts)
    judged = source.join(bad, "url", "left")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule = best_rule(host, path, rules)
    return judged.select(
        F.col("id").alias(id_col),
        host.alias("host"),
        path.alias("path"),
        rule["rule"].alias("rule"),
        F.coalesce(
            rule["verdict"], F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
        ).alias("verdict"),
        "confidence",
    )
