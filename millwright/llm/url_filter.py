"""URL filters: a trie over reversed host labels and path segments, longest match wins.

The rules are a parameter, a list on the driver; their trie is broadcast, and its
size is checked.  Each url walks its host's labels from the last to the first and,
at every host that has rules, its path's segments; the deepest host decides, then
the longest path.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: Keys of the trie that no label or segment is equal to.
PATHS, ENDS = 0, 1
#: Bytes of a pickled trie that may be broadcast.
MAX_TRIE_BYTES = 256 << 20


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def text(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)


def rule_trie(rules: tuple[UrlRule, ...]) -> dict:
    """Nested dicts: by host label from the last on, then under ``PATHS`` by path segment.

    A segment node keeps under ``ENDS`` the rules whose path ends inside the next
    segment, by the part of it that they have.  Of rules with the same host and path
    a block wins over an allow.
    """
    root: dict = {}
    for rule in rules:
        if rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"unknown verdict {rule.verdict!r}")
        node = root
        for label in reversed(lower_ascii(rule.host).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(PATHS, {})
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(ENDS, {})
        if last not in ends or rule.verdict == BLOCK:
            ends[last] = (rule.text(), rule.verdict)
    return root


def find_rule(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """Text and verdict of the rule of the longest host, then of the longest path."""
    found, node = None, root
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if PATHS in node:
            found = _longest(node[PATHS], path) or found
    return found


def _longest(node: dict, path: str) -> tuple[str, str] | None:
    found = None
    for segment in path.split("/"):
        ends = node.get(ENDS, {})
        for n in range(len(segment), -1, -1) if ends else ():
            if segment[:n] in ends:
                found = ends[segment[:n]]
                break
        node = node.get(segment)
        if node is None:
            break
    return found


def lower_ascii(text: str) -> str:
    return text if text.islower() else text.encode().lower().decode()


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: after the first ``://`` up to ``/ ? #``, then up to ``? #``; else both empty."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return lower_ascii(host), slash + path


def judge_urls(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, otherwise: str = ALLOW,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict), a row per row of ``pages``; other columns are not read.

    ``rule`` is null where none fits, and ``verdict`` is then ``otherwise``.  A null
    url, or one without ``://``, has an empty host and path, which no rule fits.  A
    url of any length is judged whole; repeated rows are rows of their own.
    """
    spark = pages.sparkSession
    trie = rule_trie(tuple(rules))
    if len(pickle.dumps(trie)) > MAX_TRIE_BYTES:
        raise ValueError("the rules are too many for a broadcast trie")
    shared = spark.sparkContext.broadcast(trie)
    id_type = pages.schema[page_id].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                host, path = split_url(value)
                rule, verdict = find_rule(root, host, path) or (None, otherwise)
                rows.append((host, path, rule, verdict))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.string()) for c in columns]],
                names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).mapInArrow(
        judged, f"page_id {id_type}, host string, path string, rule string, verdict string")
