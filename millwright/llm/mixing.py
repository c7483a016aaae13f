"""Mixing sources to target weights, by hash-random order and distributed prefix sums.

Every document gets a hash-random key.  Within each source the keys are cut into
ranges by their leading digits; the words of the ranges are summed (map-side
combined), and a prefix sum over the ranges finds the one range in which a
source's budget ends.  Only the rows of that range are sorted, and a running sum
over them finds the document at the cut.  So a plan is one row per source: how
many whole passes (epochs) it makes, the key at which the last pass stops, and
how many words of the document there it still takes.  Applying the plan is a
comparison per row; texts are never shuffled, and a source that holds most rows
is as many ranges as its share.

One row per source goes through a single window for the ranks and for sharing out
what capped sources cannot take.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import WORD, word_count
from millwright.sources.scratch import Scratch, materialize, scratch_tables

#: Documents that a key range holds on average, if they were of one source.
RANGE_ROWS = 2_000


@dataclass(frozen=True)
class Mixture:
    """Weights are dealt to the sources by rank and repeat; a source gives at most
    ``max_epochs`` times its own words."""

    weights: tuple[int, ...] = (5, 2, 1)
    max_epochs: int = 3


def random_key(doc_id: Column, text: Column) -> Column:
    """The same document has the same key in every run; order by it looks random."""
    return F.md5(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
        F.md5(F.coalesce(text, F.lit(""))),
    ))


def _targets(totals: DataFrame, mixture: Mixture) -> DataFrame:
    """(source, source_size) -> with target, by filling the caps in order of cap per weight.

    A source is capped if, with all sources before it at their caps, its share of
    what is left is at least its cap; that is where resharing the excess by weight
    comes to rest.
    """
    everything = Window.partitionBy()
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, mixture.weights))
    wide = "decimal(38,0)"
    ranked = totals.select(
        "source", "source_size",
        F.get(weights, (F.row_number().over(by_code_point) - 1) % len(mixture.weights)).alias("weight"),
        (F.col("source_size") * mixture.max_epochs).alias("cap"),
        F.sum("source_size").over(everything).alias("whole"),
    )
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("filled"),
        F.sum("weight").over(onward).alias("open_weight"),
    ).withColumn(
        "capped",
        F.col("cap").cast("decimal(28,0)") * F.col("open_weight").cast("decimal(9,0)")
        <= F.col("weight").cast("decimal(9,0)") * (F.col("whole") - F.col("filled")).cast("decimal(28,0)"),
    )
    left = F.col("whole") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    share = (F.col("weight") * left).cast(wide).cast("double") / open_weight.cast("double")
    return shared.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def plan_mixture(rows: DataFrame, tables: Scratch, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per source: source, source_size, target, epochs, cut_key, cut_words, cut_copies.

    ``rows`` has key, source and size and is read several times, so give a written
    table.  ``tables`` hold what the result reads.  The plan takes ``floor(target)`` words of each source exactly, but for
    documents of equal key at the cut (repeated rows), which share the rest evenly
    and leave fewer than their number.  A null source is a source, ranked last.  An
    empty table or a source without words gives targets of 0.
    """
    digits = max(1, math.ceil(math.log(max(rows.count(), 1) / RANGE_ROWS, 16)))
    ranges = rows.groupBy("source", F.substring("key", 1, digits).alias("range")).agg(
        F.sum("size").alias("words"))
    ranges = tables.write(ranges, "mix-ranges")
    targets = _targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), mixture)
    budget = F.floor("target").cast("long")
    epochs = F.coalesce(F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))), F.lit(0)).cast("long")
    plan = tables.write(
        targets.withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size")).coalesce(1),
        "mix-targets")

    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranges.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    last = summed.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).where(
        "rest > 0 and before < rest and rest <= before + words"
    ).select("s.source", "range", (F.col("rest") - F.col("before")).alias("wanted"))
    last = tables.write(last.coalesce(1), "mix-last")
    inside = rows.alias("r").join(
        last.alias("l"),
        F.col("r.source").eqNullSafe(F.col("l.source")) & (F.substring("r.key", 1, digits) == F.col("l.range")),
    ).groupBy("r.source", "r.key").agg(
        F.sum("size").alias("words"), F.count("*").alias("copies"), F.first("wanted").alias("wanted"))
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = inside.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))).where(
        "before < wanted and wanted <= before + words"
    ).select(
        "source", F.col("key").alias("cut_key"), (F.col("wanted") - F.col("before")).alias("cut_words"),
        F.col("copies").alias("cut_copies"))
    return plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        "p.source", "source_size", "target", "epochs", "cut_key", "cut_words", "cut_copies")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, key) of every row; a null text has size 0."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"), random_key(F.col(doc_id), F.col(text)).alias("key"))


def _last_pass(key: Column, prefix: str = "") -> tuple[Column, Column]:
    """Whether the last, partial pass takes all of a document; the words it takes of the one at the cut."""
    cut = F.col(f"{prefix}cut_key")
    shared = F.floor(F.col(f"{prefix}cut_words") / F.col(f"{prefix}cut_copies")).cast("long")
    none = F.lit(0).cast("long")
    return F.coalesce(key < cut, F.lit(False)), F.coalesce(F.when(key == cut, shared), none)


def words_taken(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes of it, repeats included.  A null or
    empty text has size 0 and gives no words; a text of any length is counted whole.
    Null sources are one source, the last.  Repeated rows are documents each; those
    that tie on their key at a source's cut share what is left of its budget.  Other
    columns are not read.  An empty table gives no rows.
    """
    rows = materialize(sized(docs), "mix-rows")
    with scratch_tables(docs.sparkSession) as tables:
        plan = materialize(plan_mixture(rows, tables, mixture).coalesce(1), "mix-plan")
    whole, part = _last_pass(F.col("key"))
    return rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select(
        "doc_id", "r.source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.when(whole, F.col("size")).otherwise(part)).alias("taken"))


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each time a document is taken.

    The document at a source's cut is there once more with the first words that the
    budget allows; its ``n_chars``, if there is such a column, follows its text.
    Documents without words are in no mix.
    """
    with scratch_tables(docs.sparkSession) as tables:
        rows = tables.write(sized(docs), "mix-rows")
        plan = materialize(plan_mixture(rows, tables, mixture).coalesce(1), "mix-plan")
    plan = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in plan.columns])
    joined = docs.withColumn("__mix_key", random_key(F.col("doc_id"), F.col("text"))).where(
        word_count(F.col("text")) > 0
    ).join(plan, F.col("source").eqNullSafe(F.col("__mix_source")))
    whole, part = _last_pass(F.col("__mix_key"), "__mix_")
    passes = (F.col("__mix_epochs") + F.when(whole, 1).otherwise(0)).cast("int")
    takes = F.concat(  # -1: the whole document; else so many words
        F.array_repeat(F.lit(-1).cast("long"), passes), F.filter(F.array(part), lambda words: words > 0))
    taken = joined.withColumn("__mix_take", F.explode(takes))
    whole_text = F.col("__mix_take") < 0
    worded = F.regexp_extract_all(F.col("text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    start = F.array_join(F.slice(worded, F.lit(1), F.greatest(F.col("__mix_take"), F.lit(1)).cast("int")), "")
    out = taken.withColumn("text", F.when(whole_text, F.col("text")).otherwise(start))
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(whole_text, F.col("n_chars")).otherwise(n_chars))
    return out.select(*docs.columns)
