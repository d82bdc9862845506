"""URL filtering by host-suffix and path-prefix expressions.

Each URL is expanded into the expressions ``host suffix + path prefix`` that a
rule could name. Expressions and rules meet in an equi-join on the first four
bytes of a SHA-256 digest; the full digest then confirms a meeting, and the
longest confirmed rule decides. All of it is built-in column expressions.

Defined results
---------------
* null URL, or one without ``://``: empty host and path, no rule, the default verdict;
* repeated rows stay repeated; each gets the verdict of its URL;
* rules with a null host or path are ignored, a path of ``""`` fits every path;
* of several fitting rules the longest ``host + path`` wins, then the longer
  host, then ``block`` before ``allow``;
* columns of the input named like one of the output columns are replaced;
* empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

#: Rules up to this count are broadcast (their rows are a few hundred bytes); beyond it the join shuffles.
BROADCAST_RULES = 50_000
#: Hex digits of the digest that the equi-join compares.
SHORT_HEX = 8

RULES_SCHEMA = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def path_prefixes(path: Column, lengths: Column) -> Column:
    """The prefixes of ``path`` whose length is one of ``lengths`` (an array column)."""
    fitting = F.filter(lengths, lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substr(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    # a line feed can be part of neither a rule's host nor the host of a URL that matters
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and
    all subdomains when the path of the URL starts with the rule's path.
    The distinct URLs are matched, so a URL that fills much of the table is
    expanded once; the verdicts come back by an equi-join that adaptive
    execution can split.
    """
    rules = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(
            F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("r_host"),
            F.col("path").alias("r_path"),
            F.col("verdict").alias("r_verdict"),
        )
        .withColumn("full", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("full", 1, SHORT_HEX))
    )
    facts = rules.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("r_path"))).alias("lengths")).first()
    if facts["n"] <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    lengths = F.array(*[F.lit(n) for n in facts["lengths"]]).cast("array<int>")

    expressions = (
        pages.select(F.col(url).alias("u"))
        .where(F.col("u").isNotNull())
        .distinct()
        .select("u", url_host(F.col("u")).alias("h"), url_path(F.col("u")).alias("p"))
        .select("u", F.explode(host_suffixes(F.col("h"))).alias("e_host"), "p")
        .select("u", "e_host", F.explode(path_prefixes(F.col("p"), lengths)).alias("e_path"))
        .withColumn("e_full", _digest(F.col("e_host"), F.col("e_path")))
        .withColumn("short", F.substring("e_full", 1, SHORT_HEX))
    )
    confirmed = expressions.join(rules, "short").where(F.col("e_full") == F.col("full"))
    best = confirmed.groupBy("u").agg(
        F.max(
            F.struct(
                (F.length("r_host") + F.length("r_path")).alias("size"),
                F.length("r_host").alias("host_size"),
                (F.col("r_verdict") == "block").alias("blocks"),
                F.concat("r_host", "r_path").alias("rule"),
                F.col("r_verdict").alias("verdict"),
            )
        ).alias("best")
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    match, key = free_name("best", pages.columns), free_name("u", pages.columns)
    best = best.select(F.col("u").alias(key), F.col("best").alias(match))
    return pages.join(best, pages[url] == best[key], "left").select(
        *[pages[c] for c in kept],
        F.coalesce(url_host(pages[url]), F.lit("")).alias("host"),
        F.coalesce(url_path(pages[url]), F.lit("")).alias("path"),
        best[match]["rule"].alias("rule"),
        F.coalesce(best[match]["verdict"], F.lit(default)).alias("verdict"),
    )
