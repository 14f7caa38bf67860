"""URL allow and block rules in a trie over reversed host labels and path segments.

A rule is a host and a path: it fits the host and all its subdomains if the
url's path starts with the rule's.  Of the fitting rules the longest wins
(host labels first, then path length), of equal ones the one listed first.
The trie has a node for each host label, read from the last to the first, and
under a host a node for each whole path segment; what follows the last slash
of a rule's path is compared as a prefix.  The trie is broadcast if its
serialised form takes at most ``MAX_TRIE`` bytes (measured).  A longer list is
joined instead (``judge_by_join``): each different url offers, for every
suffix of its host that has rules, the starts of its path that are as long as
one of those rules' paths, and these meet the rules by equality.  Both ways
give the same rows.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end.  A null url, or one
without ``://``, has empty host and path.  No fitting rule: rule null, the
default verdict.  Repeated rows are repeated; an empty table gives an empty
result; very long urls are read whole; further columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

MAX_TRIE = 64 << 20
RULES = "rank long, verdict string, host string, path string"


@dataclass
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class Trie:
    """Nodes are numbers, the root is 0; an edge leads from (node, label or segment) to a
    node, so a trie of any depth is written without recursion."""
    labels: dict[tuple[int, str], int] = field(default_factory=dict)
    segments: dict[tuple[int, str], int] = field(default_factory=dict)
    rests: dict[int, list[tuple[str, Rule]]] = field(default_factory=dict)

    def child(self, edges: dict[tuple[int, str], int], node: int, name: str) -> int:
        return edges.setdefault((node, name), len(self.labels) + len(self.segments) + 1)


def build_trie(rules: Sequence[Rule]) -> Trie:
    trie = Trie()
    for rule in rules:
        node = 0
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = trie.child(trie.labels, node, label)
        *whole, rest = rule.path.split("/")
        for segment in whole:
            node = trie.child(trie.segments, node, segment)
        trie.rests.setdefault(node, []).append((rest, rule))
    return trie


def _in_path(trie: Trie, node: int | None, path: str) -> Rule | None:
    """The rule of the longest path that ``path`` starts with."""
    best: Rule | None = None
    at = 0
    while node is not None:
        for rest, rule in trie.rests.get(node, ()):
            if path.startswith(rest, at) and (best is None or len(rule.path) > len(best.path)):
                best = rule
        cut = path.find("/", at)
        if cut < 0:
            break
        node, at = trie.segments.get((node, path[at:cut])), cut + 1
    return best


def match(trie: Trie, host: str, path: str) -> Rule | None:
    """The longest fitting rule: the deepest host node that has one wins."""
    best, node = _in_path(trie, 0, path), 0
    for label in reversed(host.split(".")):
        node = trie.labels.get((node, label))
        if node is None:
            break
        best = _in_path(trie, node, path) or best
    return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def _size(rules: Sequence[Rule]) -> int:
    """At least the bytes of the rules' texts, before a trie is built of them."""
    return sum(len(r.host) + len(r.path) + len(r.verdict) for r in rules)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", max_trie: int = MAX_TRIE) -> DataFrame:
    """``id_col``, host, path, rule (name or null), verdict for every row of ``pages``."""
    spark = pages.sparkSession
    trie = build_trie(rules) if _size(rules) <= max_trie else None
    if trie is None or len(pickle.dumps(trie)) > max_trie:
        listed = spark.createDataFrame([(i, r.verdict, r.host, r.path) for i, r in enumerate(rules)], RULES)
        return judge_by_join(pages, listed, default, id_col, url_col)
    shared = spark.sparkContext.broadcast(trie)

    @F.pandas_udf("rule string, verdict string")
    def judged(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = shared.value
        for hosts, paths in parts:
            found = [match(root, h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame({"rule": [r and r.name for r in found],
                                "verdict": [r.verdict if r else default for r in found]})

    out = _parts(pages, id_col, url_col)
    return (out.withColumn("judged", judged("host", "path"))
            .select(id_col, "host", "path", "judged.rule", "judged.verdict"))


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    return pages.select(F.col(id_col), host.alias("host"), path.alias("path"))


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """The same for a table of rules (rank, verdict, host, path) of any size, by joins.

    Urls are judged once each.  A host's rules are known by the different
    lengths of their paths, so a host with very many rules adds a row per
    length, not per rule, to a url."""
    out = _parts(pages, id_col, url_col)
    urls = out.select("host", "path").distinct()
    own = (rules.groupBy("host", "path").agg(F.min_by("verdict", "rank").alias("verdict"))
           .select(F.col("host").alias("at"), F.col("path").alias("start"), "verdict"))
    lengths = own.groupBy("at").agg(F.collect_set(F.char_length("start")).alias("lengths"))
    labels = F.split("host", r"\.", -1)
    deepest = own.agg(F.max(F.size(F.split("at", r"\.", -1)))).first()[0] or 1   # longer suffixes fit no rule
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size("labels") - deepest + 1), F.size("labels")),
                           lambda i: F.concat_ws(".", F.slice("labels", i, F.size("labels"))))
    # an empty host has one empty label; a rule of empty host fits every url
    offers = (urls.withColumn("labels", labels)
              .select("host", "path", F.explode(F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))).alias("at"))
              .join(lengths, "at")
              .select("host", "path", "at", F.explode(F.filter("lengths", lambda n: n <= F.char_length("path"))).alias("n"))
              .withColumn("start", F.left("path", F.col("n"))))
    depth = F.when(F.col("at") == "", 0).otherwise(F.size(F.split("at", r"\.", -1)))
    best = (offers.join(own, ["at", "start"]).groupBy("host", "path")
            .agg(F.max_by(F.struct(F.concat("at", "start").alias("rule"), "verdict"),
                          F.struct(depth, F.col("n"))).alias("best")))
    return (out.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
