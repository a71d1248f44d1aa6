"""Mixing sources to target weights by temperature.

A source with the token share p gets the weight p^a / sum(p^a).  The exponent a in [0, 1] is the
largest whose weights have the entropy asked for (as a share of the greatest possible), unless
some source would then be repeated too often: repetition falls as a grows, and a is raised to
the smallest exponent that keeps the limit.  Both bounds are found by bisection, many sections
at a time, each round one small aggregation over the sources.

The weights times the token budget are realised exactly: a source is taken whole as often as it
fits, and in the last epoch its blocks (documents dealt by hash, about `block_tokens` each) come
in the order of that epoch's permutation, a hash of the block, until the budget is reached; the
block in which that happens is cut between documents.  All decisions are thresholds on hashes,
one row per source; they are computed from sums per hash range, then per block, then per
document of one block, so no source, however large, is ordered as a whole.

Everything is DataFrame functions.  Defined results: a null text has no tokens, a null source
is a source of its own, a document without tokens goes with its block, repeated rows go
together, an empty table gives an empty mixture.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, key_text, stored, table

WORD = r"[^\x20\x09-\x0D]+"
SECTIONS = 32
ROUNDS = 7
RANGE_BITS = 10


@dataclass(frozen=True)
class Target:
    """entropy: of the weights, as a share of log(sources); repeats: how often a source may be
    taken; budget: tokens of the mixture, those of the corpus by default."""

    entropy: float = 0.95
    repeats: float = 4.0
    budget: int | None = None
    block_tokens: int = 100_000
    seed: int = 17


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _curve(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """exponent -> (entropy, greatest weight / share of a source)."""
    each = sources.select("log_share", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    power = F.exp(F.col("a") * F.col("log_share"))
    sums = each.groupBy("a").agg(
        F.sum(power).alias("z"),
        F.sum(power * F.col("log_share")).alias("zl"),
        F.min("log_share").alias("low"),
    )
    # One row per exponent.
    return {
        r["a"]: (
            math.log(r["z"]) - r["a"] * r["zl"] / r["z"],
            math.exp((r["a"] - 1) * r["low"]) / r["z"],
        )
        for r in sums.collect()
    }


def choose_exponent(sources: DataFrame, entropy: float, rate: float) -> float:
    """The exponent for sources with log_share.

    rate: the greatest allowed ratio of weight to share (repeats * tokens / budget).
    """
    ends = _curve(sources, [0.0, 1.0])
    # Each bracket: `ok` keeps the condition, `out` does not.
    brackets = {}
    if ends[1.0][0] < entropy:
        brackets["entropy"] = [0.0, 1.0]
    if ends[0.0][1] > rate and ends[1.0][1] <= rate:
        brackets["rate"] = [1.0, 0.0]
    holds = {"entropy": lambda v: v[0] >= entropy, "rate": lambda v: v[1] <= rate}
    for _ in range(ROUNDS if brackets else 0):
        grids = {
            k: [ok + (out - ok) * i / SECTIONS for i in range(1, SECTIONS)]
            for k, (ok, out) in brackets.items()
        }
        values = _curve(sources, sorted({a for g in grids.values() for a in g}))
        for k, grid in grids.items():
            ok, out = brackets[k]
            for a in grid:
                if holds[k](values[a]):
                    ok = a
                else:
                    out = a
                    break
            brackets[k] = [ok, out]
    largest = brackets["entropy"][0] if "entropy" in brackets else 1.0
    smallest = brackets["rate"][0] if "rate" in brackets else 0.0
    if ends[1.0][1] > rate:
        return 1.0
    return max(largest, smallest)


def weigh_sources(counted: DataFrame, target: Target) -> DataFrame:
    """(source, tokens, docs, share, weight, whole, part): how often each source is taken whole,
    and how many tokens of it once more.  counted: source, n_tokens."""
    sources = stored(
        counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")),
        "mixing-sources",
    )
    total, n = sources.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1))).first()
    total = total or 0
    budget = total if target.budget is None else target.budget
    # No mixture can be larger than all sources as often as allowed.
    budget = min(budget, int(target.repeats * total))
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    known = sources.withColumn("log_share", F.when(F.col("tokens") > 0, F.log(share)))
    exponent = 1.0
    if n > 1 and budget > 0:
        live = known.where(F.col("tokens") > 0).select("log_share")
        exponent = choose_exponent(
            live, target.entropy * math.log(n), target.repeats * total / budget
        )
    power = F.when(F.col("tokens") > 0, F.exp(F.lit(exponent) * F.col("log_share"))).otherwise(0.0)
    z = known.agg(F.sum(power)).first()[0] or 1.0
    weighed = known.select(
        "source", "tokens", "docs", share.alias("share"), (power / F.lit(z)).alias("weight")
    )
    goal = F.round(F.col("weight") * budget).cast("long")
    whole = F.when(F.col("tokens") > 0, F.floor(goal / F.col("tokens"))).otherwise(F.lit(0))
    return weighed.withColumn("whole", whole.cast("long")).withColumn(
        "part", goal - F.col("whole") * F.col("tokens")
    )


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _block(target: Target, doc: Column) -> Column:
    return F.pmod(_hash(F.lit(target.seed), doc), F.greatest(F.col("n_blocks"), F.lit(1)))


def _block_key(target: Target, epoch: Column) -> Column:
    """A block's place in the permutation of an epoch."""
    return _hash(F.lit(target.seed), F.lit("block"), F.col("source"), F.col("block"), epoch)


def _place(target: Target, doc: Column, epoch: Column) -> Column:
    """A document's place in its block in an epoch."""
    return _hash(F.lit(target.seed), F.lit("doc"), doc, epoch)


def _before_and_with(over: str, by: str) -> tuple[Column, Column]:
    """Tokens before this row and with it, in the order `by`; equal rows count together."""
    window = Window.partitionBy(over).orderBy(by)
    upto = F.sum("tokens").over(window)
    return upto - F.col("tokens"), upto


def thresholds(counted: DataFrame, weighed: DataFrame, target: Target) -> DataFrame:
    """Per source: weight, n_blocks, whole, cut_key, cut_place.

    In epoch `whole` the blocks with a key below cut_key are taken, and of the block with that
    key the documents with a place up to cut_place.  counted: doc, source, n_tokens.
    """
    n_blocks = F.ceil(F.col("tokens") / F.lit(float(target.block_tokens))).cast("long")
    sources = stored(weighed.withColumn("n_blocks", n_blocks), "mixing-weights")
    params = sources.select(
        F.col("source").alias("p_source"), "n_blocks", "whole", F.col("part").alias("budget")
    )
    dealt = counted.join(params, F.col("source").eqNullSafe(F.col("p_source")))
    dealt = dealt.withColumn("block", _block(target, F.col("doc")))
    dealt = dealt.withColumn("key", _block_key(target, F.col("whole")))
    blocks = dealt.groupBy("source", "key", "budget").agg(F.sum("n_tokens").alias("tokens"))
    blocks = stored(
        blocks.withColumn("range", F.shiftright("key", 64 - RANGE_BITS)), "mixing-blocks"
    )
    # At most 2^RANGE_BITS rows per source.
    ranges = blocks.groupBy("source", "budget", "range").agg(F.sum("tokens").alias("tokens"))
    low, upto = _before_and_with("source", "range")
    ranges = ranges.withColumn("low", low).withColumn("upto", upto)
    cut = ranges.where((F.col("low") <= F.col("budget")) & (F.col("upto") > F.col("budget")))
    cut = cut.select(
        F.col("source").alias("c_source"), F.col("range").alias("c_range"),
        (F.col("budget") - F.col("low")).alias("left"),
    )
    same = F.col("source").eqNullSafe(F.col("c_source")) & (F.col("range") == F.col("c_range"))
    inner = blocks.join(cut, same).select("source", "key", "tokens", "left")
    low, upto = _before_and_with("source", "key")
    inner = inner.withColumn("low", low).withColumn("upto", upto)
    inner = inner.where((F.col("low") <= F.col("left")) & (F.col("upto") > F.col("left")))
    inner = stored(
        inner.select(
            F.col("source").alias("b_source"), F.col("key").alias("cut_key"),
            (F.col("left") - F.col("low")).alias("left"),
        ),
        "mixing-cut-blocks",
    )
    # The documents of one block per source.
    same = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("key") == F.col("cut_key"))
    last = dealt.join(inner, same).withColumn("place", _place(target, F.col("doc"), F.col("whole")))
    last = last.groupBy("source", "left", "place").agg(F.sum("n_tokens").alias("tokens"))
    _, upto = _before_and_with("source", "place")
    last = last.withColumn("upto", upto).where(F.col("upto") <= F.col("left"))
    last = last.groupBy(F.col("source").alias("l_source")).agg(F.max("place").alias("cut_place"))
    joined = sources.join(inner, F.col("source").eqNullSafe(F.col("b_source")), "left")
    joined = joined.join(last, F.col("source").eqNullSafe(F.col("l_source")), "left")
    return stored(
        joined.select("source", "weight", "n_blocks", "whole", "cut_key", "cut_place"),
        "mixing-thresholds",
    )


def mix(
    docs: DataFrame,
    target: Target = Target(),
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """A row per document and epoch that takes it: `keep` (all columns by default), mix_epoch,
    mix_block, mix_order (the block's place in that epoch), mix_place (the document's in the
    block) and mix_weight (of the source).  Ordered by epoch, order and place they are the
    mixture."""
    keep = docs.columns if keep is None else keep
    counted = docs.select(
        key_text(doc_id).alias("doc"), F.col(source).alias("source"), n_tokens(F.col(text)).alias("n_tokens")
    )
    counted = stored(counted, "mixing-counts")
    limits = thresholds(counted, weigh_sources(counted, target), target)
    own = fresh("row")
    rows = docs.select(
        F.struct(*keep).alias(own), key_text(doc_id).alias("doc"), F.col(source).alias("source")
    )
    limits = limits.withColumnRenamed("source", "t_source")
    rows = rows.join(limits, F.col("source").eqNullSafe(F.col("t_source")))
    rows = rows.withColumn("block", _block(target, F.col("doc")))
    key, place = _block_key(target, F.col("whole")), _place(target, F.col("doc"), F.col("whole"))
    once_more = (key < F.col("cut_key")) | (
        (key == F.col("cut_key")) & (place <= F.col("cut_place"))
    )
    times = F.col("whole") + F.when(once_more, 1).otherwise(0)
    rows = rows.where(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), times.cast("int") - 1)))
    return rows.select(
        *(F.col(own)[c].alias(c) for c in keep),
        F.col("epoch").alias("mix_epoch"),
        F.col("block").alias("mix_block"),
        _block_key(target, F.col("epoch").cast("long")).alias("mix_order"),
        _place(target, F.col("doc"), F.col("epoch").cast("long")).alias("mix_place"),
        F.col("weight").alias("mix_weight"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus remixed to nearly even sources at its own size."""
    return mix(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
