"""URL filters: a trie over reversed host labels, then path segments."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.lookup import pin_small

#: Rules of a trie that is sent to every worker, at most; more rules are joined.
TRIE_RULES = 500_000
#: Hosts a worker remembers; beyond that it starts anew. Only speed depends on it.
REMEMBERED = 100_000
RULE = "host string, path string, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


class Paths:
    """Rules of one host: a trie over whole path segments; behind a rule's last slash the beginning of a segment is left."""

    def __init__(self):
        self.below: dict[str, Paths] = {}
        self.rests: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        node, *segments = self, *path.split("/")
        for segment in segments[:-1]:
            node = node.below.setdefault(segment, Paths())
        if segments[-1] not in node.rests or verdict == "block":
            node.rests[segments[-1]] = (rule, verdict)
        node.lengths = sorted({len(r) for r in node.rests}, reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        node, best = self, None
        segments = path.split("/")
        for i, segment in enumerate(segments):
            for length in node.lengths:
                found = node.rests.get(segment[:length]) if len(segment) >= length else None
                if found:
                    best = found
                    break
            node = node.below.get(segment) if i + 1 < len(segments) else None
            if node is None:
                return best
        return best


class Trie:
    """Host labels from the last to the first; a node that ends a rule's host leads on to its paths."""

    def __init__(self, rules):
        self.top: dict = {}
        self._hosts: dict[str, list[Paths]] = {}
        for host, path, verdict in rules:
            node = self.top
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            # No label holds a slash, so this key is never one.
            node.setdefault("/", Paths()).add(path, host + path, verdict)

    def __getstate__(self):
        return self.top

    def __setstate__(self, top):
        self.top, self._hosts = top, {}

    def paths(self, host: str) -> list[Paths]:
        """The path tries of the host and the domains above it, the longest host first."""
        known = self._hosts.get(host)
        if known is None:
            if len(self._hosts) >= REMEMBERED:
                self._hosts.clear()
            known, node = [], self.top
            for label in reversed(host.split(".")):
                node = node.get(label)
                if node is None:
                    break
                if "/" in node:
                    known.append(node["/"])
            known.reverse()
            self._hosts[host] = known
        return known

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, if any."""
        for paths in self.paths(host):
            found = paths.longest(path)
            if found:
                return found
        return None


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", limit: int = TRIE_RULES) -> DataFrame:
    """The rows with host, path, rule and verdict of their url; columns of these names are replaced.

    ``rules`` has (host, path, verdict): a rule fits its host and all
    subdomains if the url's path begins with the rule's.  The longest rule
    wins: the one with more host labels, then the one with the longer path; of
    two for the same host and path, ``block``.  With no fitting rule the rule
    is null and the verdict ``default``.  A null url, or one without `://`,
    has an empty host and path, which only a rule of empty host fits.  A rule
    with a null part is left out, hosts of rules are lower-cased like the
    urls'.  Repeated rows and null identifiers are rows like others.

    Rules are counted and weighed on the cluster.  Up to ``limit`` of them, 64
    MB at most, go to every worker as a trie: no shuffle, and only host and
    path enter Python.  Beyond, the nodes of the trie are keys of a join.
    """
    parts = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna()
    pinned = pin_small(rules, limit)
    if pinned is None:
        return _by_join(parts, rules, default)
    sent = df.sparkSession.sparkContext.broadcast(Trie(map(tuple, pinned.collect())))

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def look_up(host: pa.Array, path: pa.Array) -> pa.Array:
        trie, rule, verdict = sent.value, [], []
        for pair in zip(host.to_pylist(), path.to_pylist(), strict=True):
            found = trie.longest(*pair) or (None, default)
            rule.append(found[0])
            verdict.append(found[1])
        return pa.StructArray.from_arrays([pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["rule", "verdict"])

    found = parts.drop("rule", "verdict").withColumn("_found", look_up("host", "path"))
    return found.select("*", "_found.rule", "_found.verdict").drop("_found")


def _by_join(parts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for rules too many to send.

    A rule hangs at the trie node of its host and whole segments; a url visits
    one node per host suffix and path beginning, as deep as rules go.  Each
    different (host, path) visits once, and a much visited node is split by
    adaptive execution, the rules of a node being few beside its visitors.
    """
    whole = F.regexp_extract("path", r"(?s)^(.*/)?", 1)
    nodes = rules.select(
        F.col("host").alias("_host"), F.coalesce(whole, F.lit("")).alias("_whole"), F.col("path").alias("_path"), "verdict",
        F.size(F.split("host", r"\.")).alias("_labels"),
    )
    nodes = nodes.groupBy("_host", "_whole", "_path", "_labels").agg(F.max(F.struct(F.col("verdict") == "block", "verdict"))["verdict"].alias("verdict"))
    deepest = nodes.agg(F.max("_labels").alias("labels"), F.max(F.size(F.split("_whole", "/")) - 1).alias("segments")).first()
    urls = parts.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    count = F.least(F.size(labels), F.lit(deepest.labels))
    ends = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    most = F.least(F.size(segments) - 1, F.lit(deepest.segments))
    heads = F.transform(F.sequence(F.lit(0), most), lambda k: F.when(k > 0, F.concat(F.array_join(F.slice(segments, 1, F.greatest(k, F.lit(1))), "/"), F.lit("/"))).otherwise(""))
    visits = urls.select("host", "path", F.explode(ends).alias("_host"), heads.alias("_heads")).select("host", "path", "_host", F.explode("_heads").alias("_whole"))
    fits = visits.join(nodes, ["_host", "_whole"]).where(F.startswith("path", F.col("_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct("_labels", F.length("_path").alias("length"), F.concat("_host", "_path").alias("rule"), "verdict")).alias("_best"))
    joined = parts.drop("rule", "verdict").join(best, ["host", "path"], "left")
    out = joined.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}).drop("_best")
    return out.select(*[c for c in parts.columns if c not in ("rule", "verdict")], "rule", "verdict")


#: The rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

ORACLE = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES {', '.join(map(str, RULES))}),
f AS (SELECT page_id, host, path, rule_host || rule_path AS rule, verdict, length(rule_host || rule_path) AS n
      FROM u LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, arg_max(rule, n) AS rule, coalesce(arg_max(verdict, n), 'allow') AS verdict FROM f GROUP BY page_id, host, path
"""
