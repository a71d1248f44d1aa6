"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure lies above a cutoff.  Cutoffs are chosen from the
labelled documents, per stratum.  A third of them lays a path: along the upper hulls of bad
against good documents of the single rules, the step that catches most bad for good ones first,
each step lowering one rule's cutoff, as long as it tells bad from good at all.  The others are
the holdout: step by step, the exact binomial test must say that the rules together reject at
most `risk` of the good documents; the first failure ends the path.  A fixed sequence needs no
correction; over the strata Holm's method divides `error`, a stratum whose whole path passes
leaving its share to the rest.  So with probability 1 - error no stratum loses more than `risk` of
its good documents.  Of the certified steps the one that best tells bad from good is taken.

A stratum gets a cutoff from log(error / strata) / log(1 - risk) good documents of the holdout on:
86 with four strata and the defaults, so about 130 good labels.

Defined results: a null or empty text has no words and fails; labels that are null or belong to
no document are left out; a document with several labels is good only if all say so; a null
stratum counts as an empty one; without labels only the base rules reject.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textgrid as tg
from .common import stored, table, with_fields

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
WINDOW = 5

COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper".split()
# Steps of the cutoff grid, per unit of a measure.
GRID = 200


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a slice."""
    raw, offsets = tg.flat(texts)
    n = len(offsets) - 1
    starts, ends, docs = tg.words(raw, offsets)
    ranges = tg.Ranges(raw)
    hashes = ranges.hashes(starts, ends)
    at, windows = tg.grams(hashes, docs, WINDOW)
    again = at[tg.repeated(tg.keyed(windows, docs[at]))]
    covered = np.zeros(len(starts), bool)
    for j in range(WINDOW):
        covered[again + j] = True
    inside = ~tg.SPACE[raw]
    seen = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    l_start, l_end, l_doc = tg.lines(raw, offsets)
    full = seen[l_end] > seen[l_start]
    l_doc = l_doc[full]
    line = tg.keyed(ranges.hashes(l_start[full], l_end[full]), l_doc)
    _, first = np.unique(line, return_index=True)
    later = np.ones(len(line), bool)
    later[first] = False
    return {
        "n_words": np.bincount(docs, minlength=n),
        "word_chars": tg.counts_by_doc(inside & ((raw & 0xC0) != 0x80), offsets),
        "n_symbols": tg.counts_by_doc(SYMBOLS[raw], offsets),
        "n_dup_lines": np.bincount(l_doc[later], minlength=n),
        "n_repeat_words": np.bincount(docs[covered], minlength=n),
        "n_lines": np.bincount(l_doc, minlength=n),
        "n_upper": tg.counts_by_doc(_UPPER[raw], offsets),
    }


def measure(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep` and the counts of every text, in one pass without a shuffle."""
    names = [*keep, *([] if text in keep else [text])]
    place = names.index(text)
    asked = docs.select(*names)
    schema = with_fields(asked.select(*keep), {c: "long" for c in COUNTS})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tg.cut(batch, place):
                found = text_counts(part.column(place))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.array(found[c].astype(np.int64)) for c in COUNTS],
                    names=[*keep, *COUNTS],
                )

    return asked.mapInArrow(run, schema)


def base_failed() -> Column:
    few = F.col("n_words") < 10
    return few | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_measures() -> dict[str, Column]:
    """The measure of each rule, large when bad; grids reach from 0 to 1."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "upper": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "long_words": mean / 40,
        "short_words": F.greatest(1 - mean / 8, F.lit(0.0)),
    }


def _step(value: Column) -> Column:
    """The smallest grid step not below the value: a cutoff c rejects steps above c."""
    return F.ceil(F.least(value, F.lit(1.0)) * GRID).cast("int")


def binomial_below(k: np.ndarray, n: int, p: float) -> np.ndarray:
    """P(X <= k) for X ~ Binomial(n, p), exactly summed, for each of k."""
    j = np.arange(int(k.max()) + 1)
    log_c = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in j])
    terms = np.exp(log_c + j * math.log(p) + (n - j) * math.log1p(-p))
    return np.minimum(np.cumsum(terms), 1.0)[k]


def path_of(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """For each rule and grid step, at which step of the path it is rejected (beyond: never).

    good, bad: documents by rule and grid step.
    """
    rules, size = good.shape
    n, n_bad = good[0].sum(), bad[0].sum()
    moves = []
    for rule in range(rules):
        # Rejected by each cutoff, from the laxest down.
        g, b = (np.append(0, np.cumsum(x[rule][::-1])[:-1]) for x in (good, bad))
        hull = [0]
        for c in range(1, size):
            while len(hull) > 1 and (b[hull[-1]] - b[hull[-2]]) * (g[c] - g[hull[-2]]) <= (
                b[c] - b[hull[-2]]
            ) * (g[hull[-1]] - g[hull[-2]]):
                hull.pop()
            hull.append(c)
        for x, y in zip(hull, hull[1:], strict=False):
            caught, lost = int(b[y] - b[x]), int(g[y] - g[x])
            if caught * n > lost * n_bad:
                moves.append((-caught / lost if lost else -math.inf, rule, size - 1 - y))
    moves.sort(key=lambda m: (m[0], m[1], -m[2]))
    first = np.full((rules, size), len(moves))
    for number, (_, rule, cutoff) in enumerate(moves):
        first[rule, cutoff + 1 :] = np.minimum(first[rule, cutoff + 1 :], number)
    return first


def certified_steps(good: np.ndarray, bad: np.ndarray, risk: float) -> tuple[np.ndarray, np.ndarray]:
    """(the error at which the path is certified up to each step, the gain of each step).

    good, bad: documents of the holdout by the step that rejects them; the last: by none.
    """
    n, n_bad = int(good.sum()), int(bad.sum())
    k, caught = np.cumsum(good)[:-1], np.cumsum(bad)[:-1]
    if not len(k):
        return np.zeros(0), np.zeros(0)
    p = np.maximum.accumulate(binomial_below(k, n, risk)) if n else np.ones(len(k))
    return p, caught / max(1, n_bad) - k / max(1, n)


def calibrate(
    measured: DataFrame, labels: DataFrame, stratum: str, risk: float, error: float
) -> DataFrame:
    """(stratum, one cutoff step per rule) for each stratum in which a step is certified."""
    rules = rule_measures()
    names = list(rules)
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    good = good.groupBy("doc_id").agg((F.min("quality") >= 1).alias("good"))
    # A base failure is rejected whatever the cutoffs are, so it teaches them nothing.
    taught = measured.where(~base_failed()).select("doc_id", F.col(stratum).alias("stratum"), *COUNTS)
    taught = taught.join(good, "doc_id").select(
        "stratum", "good", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("lays"),
        F.array(*(_step(c) for c in rules.values())).alias("steps"),
    )
    taught = stored(taught, "quality-taught")
    sums = [F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")]
    # At most strata x rules x (GRID + 1) rows.
    cells = taught.where("lays").select("stratum", "good", F.posexplode("steps").alias("rule", "step"))
    cells = cells.groupBy("stratum", "rule", "step").agg(*sums)

    def lay(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((2, len(names), GRID + 1), np.int64)
        for k, c in enumerate(("good", "bad")):
            counts[k, rows["rule"], rows["step"]] = rows[c]
        first = path_of(*counts)
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "first": [first.reshape(-1).tolist()]})

    paths = stored(cells.groupBy("stratum").applyInPandas(lay, "stratum string, first array<int>"), "quality-paths")
    # The step that rejects a document of the holdout: the earliest one of any rule.
    each = [F.col("first")[F.col("steps")[i] + i * (GRID + 1)] for i in range(len(names))]
    held = taught.where(~F.col("lays")).join(paths, "stratum")
    held = held.groupBy("stratum", F.least(*each).alias("step")).agg(*sums)
    cuts = [f"cut_{r}" for r in names]

    def certify(path: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if path.empty:
            return pd.DataFrame(columns=["stratum", "step", "error", "gain", *cuts])
        first = np.array(path["first"].iloc[0]).reshape(len(names), GRID + 1)
        # No document has a measure of step 0 rejected, so that entry holds the length.
        size = int(first[0, 0])
        counts = np.zeros((2, size + 1), np.int64)
        for k, c in enumerate(("good", "bad")):
            counts[k, rows["step"]] = rows[c]
        p, gain = certified_steps(*counts, risk)
        lowest = {c: [int(np.flatnonzero(f > i).max()) for i in range(size)] for c, f in zip(cuts, first, strict=True)}
        return pd.DataFrame({"stratum": path["stratum"].iloc[0], "step": np.arange(size), "error": p, "gain": gain, **lowest})

    schema = "stratum string, step int, error double, gain double, " + ", ".join(f"{c} int" for c in cuts)
    steps = paths.groupBy("stratum").cogroup(held.groupBy("stratum")).applyInPandas(certify, schema)
    steps = stored(steps, "quality-steps")
    # Holm's method, over one row per stratum: whose whole path passes leaves its share to the rest.
    whole = paths.join(steps.groupBy("stratum").agg(F.max("error").alias("error")), "stratum", "left")
    by_error = Window.orderBy(F.coalesce("error", F.lit(0.0)), "stratum")
    ranked = whole.select(
        F.coalesce("error", F.lit(0.0)).alias("error"),
        F.row_number().over(by_error).alias("place"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("strata"),
    )
    missed = F.col("error") > error / (F.col("strata") - F.col("place") + 1)
    level = ranked.agg(
        (error / (F.max("strata") - F.coalesce(F.min(F.when(missed, F.col("place"))), F.max("strata")) + 1)).alias("level")
    )
    passed = steps.join(F.broadcast(level), (F.col("error") <= F.col("level")) & (F.col("gain") > 0))
    best = F.max_by(F.struct(*cuts), F.struct("gain", -F.col("step"))).alias("best")
    return passed.groupBy("stratum").agg(best).select("stratum", "best.*")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    stratum: str = "lang",
    risk: float = 0.05,
    error: float = 0.05,
) -> DataFrame:
    """doc_id, stratum, the counts, base_failed and kept of every document.

    risk: the share of a stratum's good documents that may be rejected beyond the base rules;
    error: the probability with which that may fail.
    """
    asked = docs.select(
        "doc_id",
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.col(text).alias("text"),
    )
    measured = stored(measure(asked, "text", ["doc_id", "stratum"]), "quality-counts-of-texts")
    cutoffs = stored(calibrate(measured, labels, "stratum", risk, error), "quality-cutoffs")
    judged = measured.join(cutoffs, "stratum", "left")
    rejected = F.lit(False)
    for rule, value in rule_measures().items():
        rejected = rejected | (_step(value) > F.coalesce(f"cut_{rule}", F.lit(GRID)))
    failed = base_failed()
    return judged.select(
        "doc_id", "stratum", *COUNTS, failed.alias("base_failed"), (~failed & ~rejected).alias("kept")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document, cutoffs per language."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return judged.select("doc_id", *names, "base_failed", "kept")
