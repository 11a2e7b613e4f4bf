"""URL filters: host-suffix and path-prefix expressions, joined to rules by hash prefix.

A rule has a host and a path; it fits a URL whose host is the rule's or a subdomain of it
and whose path starts with the rule's. Every rule is filed under its host and its path up to
the last slash. A URL is expanded into the same kind of expressions, but only for numbers of
host labels and slashes that some rule has. Expressions meet rules on a short prefix of
their digest; then the full digest and the rest of the path are confirmed, and the longest
rule wins (host and path together, then the longer host, then block).

Rules are joined as a table: nothing is broadcast that the engine has not found small, and
each distinct URL is expanded once, however often it occurs.

Defined results: a null URL, or one without ://, has an empty host and path and is judged by
those; a URL that no rule fits gets the default verdict and a null rule; null keys and
repeated rows are kept; an empty table gives no rows, empty rules the default everywhere;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperine.session import settle

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8
ALLOW, BLOCK = "allow", "block"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.regexp_extract(url, _PARTS, 2)


def _digest(host: Column, folder: Column) -> Column:
    # neither part can hold a line feed before the other begins: hosts end at the first slash
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(" "), host, folder), 256)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _folder(path: Column, slashes: int) -> Column:
    return F.concat(F.substring_index(path, "/", slashes), F.lit("/")) if slashes else F.lit("")


def filed_rules(rules: DataFrame) -> DataFrame:
    """Rules with digest, labels and slashes, from a table of host, path and verdict."""
    host = lower_ascii(F.coalesce("host", F.lit("")))
    path = F.coalesce("path", F.lit(""))
    named = rules.select(host.alias("rule_host"), path.alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    slashes = _slashes(F.col("rule_path"))
    folder = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 1)
    return named.distinct().withColumns({
        "labels": F.size(F.split("rule_host", r"\.")), "slashes": slashes,
        "digest": _digest(F.col("rule_host"), folder),
    }).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))


def expressions(shapes: list[tuple[int, int]]) -> Column:
    """Digests of a URL's expressions for the given numbers of labels and slashes."""
    labels = F.split("host", r"\.")
    out = []
    for n, slashes in shapes:
        suffix = F.array_join(F.slice(labels, -n, n), ".")
        fits = (F.size(labels) >= n) & (_slashes(F.col("path")) >= slashes)
        out.append(F.when(fits, _digest(suffix, _folder(F.col("path"), slashes))))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """key, host, path, rule and verdict for every row."""
    filed = settle(filed_rules(rules))
    # as many shapes as rules differ in labels and slashes
    shapes = sorted((r.labels, r.slashes) for r in filed.select("labels", "slashes").distinct().collect())
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("url"))
    urls = rows.select("url").distinct().withColumns({"host": host, "path": path})
    offered = urls.withColumn("digest", F.explode(expressions(shapes))).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS)
    )
    met = offered.join(filed.withColumnRenamed("digest", "full"), "prefix").filter(
        (F.col("digest") == F.col("full")) & F.startswith(F.col("path"), F.col("rule_path"))
    )
    length = F.length("rule_host") + F.length("rule_path")
    best = met.groupBy("url").agg(F.max(F.struct(
        length.alias("length"), F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == BLOCK).alias("blocks"), "rule_host", "rule_path", "rule_verdict",
    )).alias("best"))
    best = best.withColumnRenamed("url", "_met")
    judged = rows.join(best, F.col("url").eqNullSafe(F.col("_met")), "left")
    return judged.select(
        F.col("_key").alias(key), host.alias("host"), path.alias("path"),
        F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )


#: Rules of the registered query.
RULES = [
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
]

SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT page_id, host, path,
         (SELECT max({'n': length(h) + length(p), 'rule': h || p, 'v': v}) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM parts
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM judged
"""
