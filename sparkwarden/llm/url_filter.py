"""URL rules by longest match: a trie over reversed host labels and path segments, broadcast to the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in one broadcast trie; more rules are matched in several passes, so no broadcast grows with them.
MAX_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class _Path:
    """Whole segments lead on; the last segment of a rule is a prefix of the url's."""

    onward: dict[str, _Path] = field(default_factory=dict)
    prefixes: dict[str, tuple] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)


@dataclass
class _Host:
    onward: dict[str, _Host] = field(default_factory=dict)
    path: _Path | None = None
    whole: tuple | None = None  # a rule without a path


class Trie:
    """Rules ``(verdict, rule)``, a rule being a host and, from its first ``/``, a path."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.root = _Host()
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            host = host.translate(str.maketrans(_UPPER, _LOWER))
            node = self.root
            for label in reversed(host.split(".")):
                node = node.onward.setdefault(label, _Host())
            # Longest first; of the same length the longer host; of the same rule, block.
            value = (len(rule), len(host), verdict == "block", host + slash + path, verdict)
            if not slash:
                node.whole = max(node.whole or value, value)
                continue
            node.path = node.path or _Path()
            *segments, last = path.split("/")
            at = node.path
            for segment in segments:
                at = at.onward.setdefault(segment, _Path())
            at.prefixes[last] = max(at.prefixes.get(last, value), value)
            at.sizes = sorted({len(p) for p in at.prefixes}, reverse=True)

    def match(self, host: str, path: str) -> tuple | None:
        best, node = None, self.root
        segments = path.split("/")[1:] if path.startswith("/") else []
        for label in reversed(host.split(".")):
            node = node.onward.get(label)
            if node is None:
                break
            if node.whole and (best is None or node.whole > best):
                best = node.whole
            at = node.path
            for k, segment in enumerate(segments):
                if at is None:
                    break
                for size in at.sizes:
                    found = at.prefixes.get(segment[:size]) if size <= len(segment) else None
                    if found:
                        best = found if best is None or found > best else best
                        break
                at = at.onward.get(segment) if k + 1 < len(segments) else None
        return best


_FOUND = "struct<size:int,host:int,block:boolean,rule:string,verdict:string>"


def _matcher(trie):
    """A vectorised function of host and path: what the broadcast trie finds, or a struct of nulls."""

    @F.pandas_udf(_FOUND)
    def match(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in parts:
            found = [trie.value.match(h, p) or (None,) * 5 for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["size", "host", "block", "rule", "verdict"]).astype({"size": "Int32", "host": "Int32", "block": "boolean"})

    return match


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url", max_rules: int = MAX_RULES) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are ``(verdict, rule)`` pairs such as ``("block", "example.org/es/")``.  A rule fits its host and all
    subdomains where the url's path starts with the rule's; the longest rule wins, of equally long ones that with the
    longer host, and of two verdicts for one rule block.  Urls that no rule fits, null and malformed ones included,
    get no rule and the ``default`` verdict.  Repeated rows each get a row; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    out = pages.select(id_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    best = F.lit(None).cast(_FOUND)
    for at in range(0, len(rules), max_rules):
        trie = spark.sparkContext.broadcast(Trie(rules[at : at + max_rules]))

        match = _matcher(trie)
        found = match("host", "path")
        best = F.greatest(best, F.when(found["size"].isNotNull(), found)) if at else F.when(found["size"].isNotNull(), found)
    judged = out.withColumn("__best", best)
    return judged.select(id_col, "host", "path", F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
