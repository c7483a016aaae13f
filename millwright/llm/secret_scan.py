"""Secret scans with built-in functions only.

Three patterns find assignments, access keys and hex digests.  A second pass looks
at candidate strings, runs of one character class: a window slides over each, its
symbol counts are kept by adding the symbol that enters and taking out the one
that leaves, and with them the window's Shannon entropy.  Windows at or above the
class's threshold are joined into spans, unless an allow-list knows the string.

Where a match starts follows from the lengths of what a split leaves between the
matches.  Texts without a match, nearly all, cost one search per pattern.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: A run found by a lower bound on its length is the whole run, so these two need no check afterwards.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGNED = 8
BASE_KINDS = ("assign", "access", "hex")
#: Matches of one text are placed in blocks, so that adding to a list stays cheap.
BLOCK = 256
#: Counts are kept in millionths of ``c * log2(c)``, as integers: sums have no drift.
SCALE = 1_000_000


@dataclass(frozen=True)
class CharClass:
    """Runs of ``symbols`` at least ``window`` long; ``bits`` is the entropy that makes a window random."""

    kind: str
    symbols: str
    window: int
    bits: float

    def run(self) -> str:
        return f"[{self.symbols}]{{{self.window},}}"

    def most(self) -> int:
        """The largest sum of ``c * log2(c)``, scaled, of a window at the threshold."""
        return round((math.log2(self.window) - self.bits) * self.window * SCALE)


CLASSES = (
    CharClass("entropy_hex", "0-9A-Fa-f", 24, 3.0),
    CharClass("entropy_base64", "A-Za-z0-9+/_-", 24, 4.0),
)
#: Strings that look random and are none: words, numbers, paths and ruled lines, examples.
#: A repeated group has to be possessive: the pattern engine goes one call deeper for each repeat of another.
ALLOWED = (
    r"^[A-Za-z_-]*$",
    r"^[0-9_+/-]*$",
    r"^[A-Za-z]++(?:[/_-][A-Za-z]++)*+(?:[/_-][0-9]+)?$",
    r"(?i)example|placeholder|xxxxxxxx|0123456789|abcdefghij",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(values: Column) -> Column:
    last = F.floor((F.size(values) - 1) / F.lit(BLOCK)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(cut, 1, 0))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start,end,found>>: leftmost matches that do not overlap, in code points.

    ``found`` is the given group of the match.  No match, or a null text, gives an
    empty array.
    """
    kind = "array<struct<start:int,end:int,found:string>>"
    between = F.transform(F.split(text, pattern, -1), F.length)
    length = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    raw = F.zip_with(
        F.zip_with(between, length, lambda gap, n: F.struct(gap.alias("gap"), n.alias("len"))), found,
        lambda m, f: F.struct(m["gap"].alias("gap"), m["len"].alias("len"), f.alias("found")))
    raw = F.filter(raw, lambda m: m["len"].isNotNull())  # what follows the last match

    def place(state: Column, match: Column) -> Column:
        start = state["at"] + match["gap"]
        end = start + match["len"]
        span = F.struct(start.alias("start"), end.alias("end"), match["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    empty = F.array().cast(kind)

    def place_block(state: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(state["at"].alias("at"), empty.alias("spans")), place)
        return _let(done, lambda d: F.struct(
            d["at"].alias("at"), F.concat(state["blocks"], F.array(d["spans"])).alias("blocks")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("blocks"))
    placed = _let(raw, lambda m: F.aggregate(_blocks(m), start, place_block, lambda s: F.flatten(s["blocks"])))
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def _cost(count: Column) -> Column:
    """``c * log2(c)`` in millionths."""
    return F.when(count > 1, F.round(count * F.log2(count) * SCALE)).otherwise(0).cast("long")


def random_spans(run: Column, symbols: CharClass) -> Column:
    """array<struct<start,end>> of a string: its windows of high entropy, those that touch joined.

    A string shorter than the window has none.
    """
    spans = "array<struct<start:int,end:int>>"
    width = symbols.window
    entering = F.transform(F.split(run, ""), lambda c: F.ascii(c))
    leaving = _let(entering, lambda e: F.concat(
        F.array_repeat(F.lit(-1), width), F.slice(e, F.lit(1), F.greatest(F.size(e) - width, F.lit(0)))))
    steps = F.zip_with(entering, leaving, lambda a, b: F.struct(a.alias("add"), b.alias("drop")))
    state = F.struct(
        F.lit(0).alias("at"), F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("cost"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(spans).alias("spans"))

    def step(s: Column, x: Column) -> Column:
        less = F.when(x["drop"] >= 0, F.get(s["counts"], x["drop"])).otherwise(0)
        same = x["add"] == x["drop"]
        more = F.get(s["counts"], x["add"])
        cost = F.when(same, s["cost"]).otherwise(
            s["cost"] + _cost(more + 1) - _cost(more) - F.when(x["drop"] >= 0, _cost(less) - _cost(less - 1)).otherwise(0))
        counts = F.transform(s["counts"], lambda c, i: c + F.when(i == x["add"], 1).otherwise(0) - F.when(i == x["drop"], 1).otherwise(0))
        at = s["at"] + 1
        return _let(F.struct(cost.alias("cost"), ((at >= width) & (cost <= symbols.most())).alias("hit")), lambda n: F.struct(
            at.alias("at"), counts.alias("counts"), n["cost"].alias("cost"),
            F.when(n["hit"] & (s["end"] < at - width), at - width).otherwise(s["start"]).alias("start"),
            F.when(n["hit"], at).otherwise(s["end"]).alias("end"),
            F.when(
                n["hit"] & (s["end"] >= 0) & (s["end"] < at - width),
                F.concat(s["spans"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))),
            ).otherwise(s["spans"]).alias("spans")))

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(s["end"] >= 0, F.concat(s["spans"], last)).otherwise(s["spans"])

    return F.when(F.length(run) >= width, F.aggregate(steps, state, step, finish)).otherwise(F.array().cast(spans))


def entropy_spans(text: Column, symbols: CharClass, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """array<struct<start,end>> of a text: random windows of the class's runs that no allow-list pattern knows."""
    candidates = matches(text, symbols.run())
    if allowed:
        known = "|".join(f"(?:{pattern})" for pattern in allowed)
        candidates = F.filter(candidates, lambda m: ~m["found"].rlike(known))
    placed = F.transform(candidates, lambda m: F.transform(
        random_spans(m["found"], symbols),
        lambda s: F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end"))))
    return F.flatten(placed)


def _tagged(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank of the kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base (text), findings (array), spans (text).

    A finding is (start, rank, end, kind) in code points, end exclusive.  Base spans
    are never suppressed; a random window that lies inside one is not told again.
    A null or empty text has no findings, empty ``base`` and ``spans``; texts and runs
    in them may be of any length.  Repeated
    rows are rows of their own; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    column = F.col("__text")
    rows = rows.select(
        "doc_id",
        F.filter(matches(column, ASSIGN, 1), lambda m: F.length(m["found"]) >= MIN_ASSIGNED).alias("__assign"),
        matches(column, ACCESS).alias("__access"), matches(column, HEX).alias("__hex"),
        *[entropy_spans(column, c, allowed).alias(f"__{c.kind}") for c in classes])
    base = F.concat(*[_tagged(F.col(f"__{kind}"), kind, i) for i, kind in enumerate(BASE_KINDS)])
    rows = rows.withColumn("__base", base)
    more = [
        F.filter(
            _tagged(F.col(f"__{c.kind}"), c.kind, len(BASE_KINDS) + i),
            lambda s: ~F.exists("__base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
        for i, c in enumerate(classes)
    ]
    found = rows.withColumn("findings", F.array_sort(F.concat("__base", *more)))
    return found.select(
        "doc_id", *[F.size(f"__{kind}").cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        _joined(F.col("__base")).alias("base"), "findings", _joined(F.col("findings")).alias("spans"))
