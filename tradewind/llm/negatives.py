"""Hard negatives by Fagin's threshold algorithm.

Vectors become integers; a row's score is its inner product with an anchor.  All rows are dealt
into blocks of about BLOCK_ROWS by a hash of their id.  A block keeps, per dimension, the list of
its rows sorted by that component.  For an anchor each list is read from the end that its sign
asks for (sorted access); what appears is scored as a whole (random access, integers).  The
components at the depth reached give a threshold that no unseen row can exceed, and a block is
left once that threshold is strictly below the k-th score of every window of the anchor, or
below the window itself.  Strictly: an unseen row with an equal score may have a smaller id.

Windows of the first pass: rows of the anchor's own label, any score (its positives).  Windows of
the second: per positive the rows of other labels with low * positive <= 100 * score <=
100 * positive.  A task carries its k best rows per window from block to block, so the bar
rises as it goes and a task returns k rows per window; a last grouping merges the tasks.

Anchors are a stated query set.  They meet the blocks in passes of at most PASS_ANCHORS
vectors, which are broadcast (a bounded size); every pass reads all blocks, and only blocks
and anchors of one pass are in memory.  Blocks are stored, anchors never reach the driver.

Defined results.  Rows with a null id, label or vector or any null or non-finite component take
no part.  Of rows with equal ids the one with the smallest label, then vector, counts.  Shorter
vectors are as if filled with zeros.  A row with a component beyond `limit(dimensions)` in size
after scaling, whose scores might not fit 64 bits, takes no part either.  An anchor without
positives, or whose windows are empty, has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .packed import squeeze, unsqueeze

SCALE = 256
BLOCK_ROWS = 4096
BATCH_ANCHORS = 1024
PASS_ANCHORS = 16 * BATCH_ANCHORS
# Places of a list that the first step reads to; every further one reads GROWTH times as deep.
FIRST_DEPTH = 8
GROWTH = 4


def limit(dimensions: int) -> int:
    """The largest component for which every score fits 63 bits."""
    return isqrt((1 << 62) // max(1, dimensions))


def integer_vectors(rows: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(id, label, q) of the rows that take part: components are floor(scale * x), one row per id."""
    q = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    own = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.when(fine, q).alias("q"))
    own = own.where("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL")
    one = own.groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"))
    return one.select("id", "row.label", "row.q")


_BLOCK = "block long, n long, ids binary, labels binary, vectors binary"


def _matrix(rows: pd.DataFrame, dimensions: int) -> np.ndarray:
    out = np.zeros((len(rows), dimensions), np.int64)
    for k, q in enumerate(rows["q"]):
        out[k, : len(q)] = q
    return out


def blocks(vectors: DataFrame, dimensions: int, n_blocks: int) -> DataFrame:
    """Rows of _BLOCK: about BLOCK_ROWS vectors each, as bytes, by a hash of the id."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        own = [rows[c].to_numpy(np.int64).tobytes() for c in ("id", "label")]
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "n": [len(rows)], "ids": [own[0]],
                             "labels": [own[1]], "vectors": [squeeze(_matrix(rows, dimensions))]})

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    return dealt.repartition(n_blocks, "block").groupBy("block").applyInPandas(pack, _BLOCK)


class Lists:
    """The rows of a block, and per dimension their order by that component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.largest = int(np.abs(vectors).max(initial=0))
        self._exact = vectors
        self._vectors = vectors.astype(np.float64)
        # Ascending per dimension: positive anchors read from the end, negative from the front.
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        self._sorted = np.sort(vectors, axis=0).T

    def access(self, anchor: np.ndarray, depth: int, upto: int) -> tuple[np.ndarray, int]:
        """(rows at places depth to upto of the anchor's lists, the threshold behind them)."""
        n = len(self.ids)
        up, down = anchor > 0, anchor < 0
        rows = [self.order[up, n - upto : n - depth].ravel(), self.order[down, depth:upto].ravel()]
        last = np.where(up, self._sorted[:, n - upto], self._sorted[:, upto - 1])
        return np.concatenate(rows), int(last @ anchor)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products; in doubles where all sums stay below 2**53."""
        if self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53:
            return (self._vectors[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self._exact[rows] @ anchor


class Best:
    """The k best (score, id) of an anchor's windows, for rows seen so far."""

    def __init__(self, lows: list[int | None], highs: list[int | None], k: int):
        """lows, highs: of 100 * score, per window; None for no bound."""
        self.k, self.lows, self.highs = k, lows, highs
        self.empty = [low is not None and low > high for low, high in zip(lows, highs, strict=True)]
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in lows]

    def beyond(self, threshold: int) -> bool:
        """Whether no row with at most this score can enter any window."""
        for low, empty, (scores, _) in zip(self.lows, self.empty, self.rows, strict=True):
            if empty:
                continue
            full = len(scores) == self.k and threshold < scores[-1]
            if not full and (low is None or 100 * threshold >= low):
                return False
        return True

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (low, high) in enumerate(zip(self.lows, self.highs, strict=True)):
            fits = np.ones(len(scores), bool)
            if low is not None:
                # Rounded bounds, so that nothing is multiplied beyond 64 bits.
                fits = (scores >= -(-low // 100)) & (scores <= high // 100)
            held, names = self.rows[w]
            if len(held) == self.k:
                fits &= scores >= held[-1]
            if not fits.any():
                continue
            s, i = np.concatenate([held, scores[fits]]), np.concatenate([names, ids[fits]])
            order = np.lexsort((i, -s))[: self.k]
            self.rows[w] = (s[order], i[order])


def search(lists: Lists, anchor_id: int, label: int, anchor: np.ndarray, best: Best, same: bool) -> int:
    """Read the lists of a block until nothing unseen can matter; the number of scored rows."""
    n, depth, step, scored = len(lists.ids), 0, FIRST_DEPTH, 0
    seen = np.zeros(n, bool)
    while depth < n:
        # An anchor of zeros has no lists to read: all scores are equal.
        upto = min(n, step) if anchor.any() else n
        rows, threshold = lists.access(anchor, depth, upto)
        new = np.zeros(n, bool) if anchor.any() else np.ones(n, bool)
        new[rows] = True
        new &= ~seen
        seen |= new
        new = np.flatnonzero(new)
        new = new[((lists.labels[new] == label) == same) & (lists.ids[new] != anchor_id)]
        scored += len(new)
        best.offer(lists.scores(new, anchor), lists.ids[new])
        depth, step = upto, upto * GROWTH
        if best.beyond(threshold):
            break
    return scored


_FOUND = "anchor long, part int, score long, id long"


def _paired(stored_blocks: DataFrame, batches: DataFrame, number: int) -> DataFrame:
    """Every block with every batch of a pass, which is broadcast."""
    own = batches.where(F.col("pass") == number)
    return stored_blocks.withColumn("pass", F.lit(number).cast("long")).join(F.broadcast(own), "pass")


def _searched(pairs: DataFrame, dimensions: int, k: int, low: int | None) -> DataFrame:
    """Rows of _FOUND: per task, anchor and window (part) the k best rows.

    low None: rows of the same label.  Else windows below the scores in `lows`.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        block, lists = None, None
        for frame in frames:
            for at in range(len(frame)):
                (row,) = frame.slice(at, 1).to_pylist()
                if row["block"] != block:
                    block = row["block"]
                    lists = Lists(*_arrays(row, "ids", "labels"), _vectors(row, "vectors", dimensions))
                if row["batch"] not in held:
                    held[row["batch"]] = _anchors(row, dimensions, k, low)
                for anchor_id, label, anchor, best in held[row["batch"]]:
                    search(lists, anchor_id, label, anchor, best, low is None)
        out = [(a, w, s, i) for batch in held.values() for a, _, _, best in batch
               for w, (scores, ids) in enumerate(best.rows)
               for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["anchor", "part", "score", "id"],
        )

    return pairs.mapInArrow(run, _FOUND)


def _arrays(row: dict, *names: str) -> list[np.ndarray]:
    return [np.frombuffer(row[n], np.int64) for n in names]


def _vectors(row: dict, name: str, dimensions: int) -> np.ndarray:
    return unsqueeze(row[name], np.int64).reshape(-1, dimensions)


def _anchors(row: dict, dimensions: int, k: int, low: int | None) -> list:
    ids, labels = _arrays(row, "a_ids", "a_labels")
    vectors = _vectors(row, "a_vectors", dimensions)
    if low is None:
        return [(int(i), int(x), v, Best([None], [None], k)) for i, x, v in zip(ids, labels, vectors, strict=True)]
    tops, sizes = _arrays(row, "tops", "n_tops")
    out, at = [], 0
    for i, x, v, n in zip(ids, labels, vectors, sizes.tolist(), strict=True):
        scores = [int(s) for s in tops[at : at + n]]
        out.append((int(i), int(x), v, Best([low * s for s in scores], [100 * s for s in scores], k)))
        at += n
    return out


_BATCH = (
    "pass long, batch long, a_ids binary, a_labels binary, a_vectors binary, tops binary, n_tops binary"
)


def _batches(anchors: DataFrame, dimensions: int) -> DataFrame:
    """Rows of _BATCH from (id, label, q, batch, tops: positive scores in order)."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        tops = [np.array(t, np.int64) for t in rows["tops"]]
        batch = int(rows["batch"].iloc[0])
        numbers = [rows["id"], rows["label"], np.concatenate([np.zeros(0, np.int64), *tops]), [len(t) for t in tops]]
        ids, labels, scores, sizes = (np.asarray(x, np.int64).tobytes() for x in numbers)
        return pd.DataFrame({"pass": [batch * BATCH_ANCHORS // PASS_ANCHORS], "batch": [batch], "a_ids": [ids],
                             "a_labels": [labels], "a_vectors": [squeeze(_matrix(rows, dimensions))],
                             "tops": [scores], "n_tops": [sizes]})

    return anchors.groupBy("batch").applyInPandas(pack, _BATCH)


def _merged(found: DataFrame, k: int, key: list[str]) -> DataFrame:
    """The k best of each window over all tasks, with their rank from 1."""
    first = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _passes(stored_blocks, batches, n_passes, dimensions, k, low, key, label) -> DataFrame:
    parts = [
        stored(_merged(_searched(_paired(stored_blocks, batches, p), dimensions, k, low), k, key), label)
        for p in range(n_passes)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """Rows of _RESULT for (id, label, q) rows, one per id (`integer_vectors`).

    is_anchor: a condition on id, label and q.  low: percent of the positive's score.
    """
    spark = vectors.sparkSession
    kept = stored(vectors, "negatives-vectors")
    size = kept.agg(F.max(F.size("q")).alias("dimensions")).first()
    dimensions = size["dimensions"] or 0
    most = limit(dimensions)
    kept = kept.where(F.forall("q", lambda x: F.abs(x) <= most))
    counts = kept.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors")).first()
    if not dimensions or not counts["anchors"]:
        return spark.createDataFrame([], _RESULT)
    n_blocks = -(-counts["n"] // BLOCK_ROWS)
    n_batches = -(-counts["anchors"] // BATCH_ANCHORS)
    n_passes = -(-n_batches * BATCH_ANCHORS // PASS_ANCHORS)
    packed = stored(blocks(kept, dimensions, n_blocks), "negatives-blocks")

    anchors = kept.where(is_anchor).withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(n_batches)))
    alone = stored(_batches(anchors.withColumn("tops", F.array().cast("array<long>")), dimensions), "anchors")
    positives = _passes(packed, alone, n_passes, dimensions, n_positives, None, ["anchor"], "positives")

    tops = positives.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x.score).alias("tops")
    )
    windows = anchors.join(tops.withColumnRenamed("anchor", "id"), "id")
    batches = stored(_batches(windows, dimensions), "anchor-windows")
    negatives = _passes(packed, batches, n_passes, dimensions, n_negatives, low, ["anchor", "part"], "negatives")

    positive = positives.select(
        "anchor", (F.col("rank") - 1).alias("part"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return negatives.join(positive, ["anchor", "part"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the anchors of the contract."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = integer_vectors(rows, "vec_id", "embedding", label)
    return mine(vectors, F.col("id") % 100 == 0)


SQL = {
    "op13_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same,
    list_inner_product(a.q, v.q)::BIGINT AS score
  FROM whole a JOIN whole v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""
}
