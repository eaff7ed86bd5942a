"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

A rule (host, path, verdict) fits a URL whose host is the rule's or a subdomain of it
and whose path starts with the rule's. Each distinct (host, path) is expanded into the
expressions "last k labels of the host + first m characters of the path", for the pairs
(k, m) that occur among the rules, so the expansion grows with the shapes of the rules and
not with the length of the URL, and no fitting rule is out of reach. Distinct expressions are joined
with the rules on the first hex digits of their SHA-256; the full digest confirms a hit.
Of the rules that fit, the longest (host and path together, then the host) wins; rules equal in host and path block
if one of them blocks.

A hot host costs one row in the first join: expressions are made distinct before the
shuffle. The confirmed ones (at most one per rule) go back to the URLs by a broadcast
only while their counted number is within ``broadcast_rules``, else by a shuffle join
that adaptive execution splits where an expression is hot.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased (a port or user name belongs to it); the path is what follows up to ``?``, ``#`` or the end; a null URL or one without ``://``
has both empty. Without a fitting rule the rule is null and the verdict ``default``. Rules with a null or empty
host or a verdict other than allow and block are refused with an error; a null rule path counts as empty. Rows
that repeat come out each; other columns pass through, and a clashing name gets an underscore added in the output
columns; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, fresh, let, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; see the module text."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path): its expression, digest, verdict and shape."""
    r = rules.select(F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                     F.lower(F.col("verdict").cast("string")).alias("verdict"))
    bad = F.coalesce(F.col("host") == "", F.lit(True)) | ~F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False))
    r = r.withColumn("verdict", F.when(bad, F.raise_error(F.lit("a rule needs a host and a verdict, allow or block"))).otherwise(F.col("verdict")))
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block comes after allow
    return r.select(F.concat("host", "path").alias("rule"), F.sha2(F.concat("host", F.lit("/"), "path"), 256).alias("digest"), "verdict",
                    _labels(F.col("host")).cast("int").alias("k"), F.length("path").alias("m"), F.length("host").alias("h"))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The expressions of a URL: one for each (labels, characters) that its host and path are long enough for.

    A slash parts host and path, which no host has, so different pairs never read alike.
    """
    wanted = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(m).alias("m")) for k, m in shapes))

    def expand(labels: Column) -> Column:
        fit = F.filter(wanted, lambda s: (s["k"] <= F.size(labels)) & (s["m"] <= F.length(path)))
        return F.transform(fit, lambda s: F.concat(F.array_join(F.slice(labels, -s["k"], s["k"]), "."), F.lit("/"), F.substr(path, F.lit(1), s["m"])))

    return let(F.split(host, r"\.", -1), expand)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", prefix_digits: int = 8,
               broadcast_rules: int = 200_000) -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict; see the module text."""
    host, path, rule, verdict = (fresh(pages, c) for c in ("host", "path", "rule", "verdict"))
    book = written(_rules(rules), "rules")
    shapes = sorted((r["k"], r["m"]) for r in book.select("k", "m").distinct().collect())  # at most labels x path lengths of the rules
    h, p = split_url(F.col(url).cast("string"))
    parsed = pages.withColumn(host, h).withColumn(path, p)
    if not shapes:
        return parsed.withColumn(rule, F.lit(None).cast("string")).withColumn(verdict, F.lit(default))
    urls = written(parsed.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct(), "urls")
    spread = urls.select("h", "p", F.explode(expressions(F.col("h"), F.col("p"), shapes)).alias("expression"))
    seen = spread.select("expression").distinct().withColumn("full", F.sha2("expression", 256))
    fits = written(seen.withColumn("short", F.substring("full", 1, prefix_digits))
                   .join(book.withColumn("short", F.substring("digest", 1, prefix_digits)), "short")
                   .where(F.col("full") == F.col("digest")).select("expression", "rule", "verdict", F.struct(F.length("rule"), "h").alias("rank")), "fits")
    known = F.broadcast(fits) if fits.count() <= broadcast_rules else fits
    best = spread.join(known, "expression").groupBy("h", "p").agg(F.max_by(F.struct("rule", "verdict"), "rank").alias("best"))
    best = written(best.select(F.col("h").alias(host), F.col("p").alias(path), F.col("best.rule").alias(rule), F.col("best.verdict").alias(verdict)), "verdicts")
    discard(urls), discard(fits), discard(book)
    out = parsed.join(best, [host, path], "left")
    return out.select(*(F.col(f"`{c}`") for c in pages.columns), host, path, rule, F.coalesce(verdict, F.lit(default)).alias(verdict))
