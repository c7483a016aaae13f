"""Quality rules as a ledger of failure bits.

Each text is measured once, in Arrow batches; every rule is an expression over the
measurements and is evaluated once, into one bit.  The ledger keeps the
measurements and the bits.  A policy is a named set of rules, so applying another
version of it, or asking what each rule removes, reads only the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.text import BLANKS, releasing

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` is never given to another rule."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 12 * n_words"),
    Rule(4, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(6, "shouting", "100 * n_upper > 50 * word_chars"),
)

#: Versions of the policy: names of the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    # repeated lines alone mark good documents too; line dedup deals with them
    "v2": ("few_words", "repeated_windows", "short_words", "long_words", "symbols", "shouting"),
}
CURRENT = "v2"


def mask(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of a policy; an unknown policy or rule raises KeyError."""
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in set(POLICIES[policy]))


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows of three words that the text has twice or more, the first included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(ids) + w[2:]
    _, group, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[group] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def _measure(text: bytes, n_chars: int) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        n_chars - (len(text) - len(text.translate(None, BLANKS))),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(text) - len(text.translate(None, UPPER)),
    )


def _measured(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(text_at)
        chars = pc.fill_null(pc.utf8_length(text), 0).to_pylist()
        raw = text.cast(pa.large_binary() if text.type == pa.large_string() else pa.binary())
        rows = [_measure(value.as_py() or b"", n) for value, n in zip(raw, chars, strict=True)]
        columns = np.array(rows, np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(columns[:, i]) for i in range(len(MEASURES)))],
            names=[*batch.schema.names, *(f"__{m}" for m in MEASURES)])


def ledger(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``keep`` columns, the measurements (long) and ``failures`` (long), a row per row of ``docs``.

    Words are runs without ASCII blanks; word_chars counts code points; a line is
    repeated if it has a word and equals an earlier line of the text.  A null text
    has no words and fails as an empty one does; one of any length is read whole, by
    the task that has it.  Repeated rows are rows of their own; columns not kept are
    not read.
    """
    read = [*keep, *([] if text in keep else [text])]
    measured = _numbered(docs, read).mapInArrow(
        releasing(lambda batches: _measured(batches, read.index(text))),
        ", ".join([f"__keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(read)]
                  + [f"__{m} bigint" for m in MEASURES]))
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    names = [F.col(f"__keep_{i}").alias(c) for i, c in enumerate(read) if c in keep]
    judged = measured.withColumnsRenamed({f"__{m}": m for m in MEASURES}).withColumn("__failures", bits)
    return judged.select(*names, *MEASURES, F.col("__failures").alias("failures"))


def _numbered(docs: DataFrame, read: list[str]) -> DataFrame:
    return docs.select(*[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(read)])


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(entries: DataFrame, policy: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: rule, failed, only_this (rows kept again without it), failed_with_others.

    Rows are first counted by pattern of bits, of which there are at most two to the
    number of rules, then per rule.
    """
    chosen = mask(policy, rules)
    patterns = entries.groupBy(F.col("failures").bitwiseAND(F.lit(chosen)).alias("bits")).agg(F.count("*").alias("n"))
    bits = entries.sparkSession.createDataFrame(
        [(r.name, 1 << r.bit) for r in rules if chosen >> r.bit & 1], "rule string, bit long")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return bits.join(patterns, hit, "left").groupBy("rule").agg(
        count(hit)("failed"),
        count(F.col("bits") == F.col("bit"))("only_this"),
        count(hit & (F.col("bits") != F.col("bit")))("failed_with_others"))


def kept_documents(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns, in the one measuring pass."""
    numbered = _numbered(docs, docs.columns)  # columns may be called as the measurements are
    judged = apply_policy(ledger(numbered, tuple(numbered.columns), f"__keep_{docs.columns.index(text)}"), policy)
    return judged.where("kept").select(*[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(docs.columns)])
