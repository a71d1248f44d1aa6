"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items give word n-grams, the seeds.  A first pass counts in how many places of the corpus
each seed stands; a seed is rare if it is not far more frequent than the other seeds of its
item (an item that was copied into a third of all documents keeps its seeds).  A second pass
looks up all seeds in every document, cuts the document around each group of hits out, and
aligns it with the item word by word: matching words score +2, a changed, added or missing word
-1.  A document leaks an item if the best local alignment reaches `least` of the item's full
score, which edited and paraphrased copies do and chance hits do not.

A group with a rare seed is always aligned.  A group of frequent seeds alone is aligned unless
its words show that no alignment can reach the score (`_may_reach`, an exact bound), so the
rarity of seeds saves work and decides nothing.

A copy may be edited so that no seed survives, every third word changed for instance.  Such a
copy must keep many single words (`words_due`), so some of any few words of the item are among
them: the words rarest in the corpus are looked up too, and places where enough of them stand
close together are aligned as well.  Together the two find every leak there is.

Items of fewer than `short` words are a rule of their own, since a word or two stand in many
clean documents: they leak only where they stand whole, and `without_leaks` drops no document
for them.

Both passes are maps: no document is shuffled.  The items are taken in blocks of at most
`block` items, each block one broadcast of bounded size and one pass; a benchmark of any size
is a row of such blocks.

Defined results: null and empty texts or items leak nothing; an item shorter than a seed is
its own seed and, like all short ones, reported where it stands whole; repeated documents each get their rows; repeated items are separate items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textgrid as tg
from .common import stored, table, with_fields

SEED = 3
MATCH, OTHER = 2, -1
# Items of fewer words (never less than a seed) leak whole or not at all.
SHORT = 5
# Single words looked up beyond the least number: as many more of them must then stand together.
EXTRA = 4


def words_due(n: int, least: float, seed: int = SEED) -> int:
    """Words that an alignment of the share `least` matches if no `seed` of them stand in a row.

    m matches in runs of at most seed - 1 have ceil(m / (seed - 1)) - 1 other steps between them.
    More than n: there is no such alignment.
    """
    for m in range(1, n + 1):
        if MATCH * m + OTHER * (-(-m // (seed - 1)) - 1) >= MATCH * n * least - 1e-9:
            return m
    return n + 1


class Items:
    """A block of test items: word hashes, and seeds in sorted order."""

    def __init__(self, ids: list, texts: list[str | None]):
        raw, offsets = tg.flat(pa.array(texts, pa.string()))
        raw = tg.LOWER[raw]
        starts, ends, docs = tg.words(raw, offsets)
        hashes = tg.Ranges(raw).hashes(starts, ends)
        self.ids = ids
        self.words = np.split(hashes, np.searchsorted(docs, np.arange(1, len(ids))))[: len(ids)]
        seeds, owners, places = [], [], []
        for i, w in enumerate(self.words):
            for size in {min(SEED, len(w))} - {0}:
                at, h = tg.grams(w, np.zeros(len(w), np.int64), size)
                seeds.append(h)
                owners.append(np.full(len(h), i))
                places.append(at)
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        hashes, self.owner, self.place = join(seeds, np.uint64), join(owners, np.int64), join(places, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place, self.sorted = self.owner[order], self.place[order], hashes[order]
        self.sizes = sorted({min(SEED, len(w)) for w in self.words} - {0})
        self.rare = np.ones(len(hashes), bool)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.known = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        self.single, self.single_owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.due = np.zeros(len(ids), np.int64)

    def least(self, least: float, short: int) -> np.ndarray:
        """The share that each item asks for."""
        return np.where(self.lengths < max(short, SEED), 1.0, least)

    def choose_words(self, counts: np.ndarray, least: np.ndarray) -> None:
        """The rarest words of each item (`counts`: of `known`) that no leak without seeds avoids.

        Such a leak matches m of n words, so of any r words it matches r - n + m or more.
        """
        chosen, owners = [], []
        for i, w in enumerate(self.words):
            m = words_due(len(w), least[i]) if len(w) >= SEED else len(w) + 1
            if m > len(w):
                continue
            n = min(len(w), len(w) - m + 1 + EXTRA)
            rarest = np.argsort(counts[np.searchsorted(self.known, w)], kind="stable")[:n]
            self.due[i] = n - len(w) + m
            chosen.append(w[rarest])
            owners.append(np.full(n, i))
        if chosen:
            words, owners = np.concatenate(chosen), np.concatenate(owners)
            order = np.argsort(words, kind="stable")
            self.single, self.single_owner = words[order], owners[order]


class Slice:
    """The words of a slice of documents, and where seeds stand in them."""

    def __init__(self, texts: pa.Array):
        raw, offsets = tg.flat(texts)
        raw = tg.LOWER[raw]
        self.starts, self.ends, self.docs = tg.words(raw, offsets)
        self.hashes = tg.Ranges(raw).hashes(self.starts, self.ends)
        self.n = len(offsets) - 1
        self.begin = np.searchsorted(self.docs, np.arange(self.n + 1))

    def hits(self, items: Items) -> tuple[np.ndarray, np.ndarray]:
        """(word position in the slice, number of the seed), a pair for each equal seed."""
        at, seed = [], []
        for size in items.sizes:
            places, h = tg.grams(self.hashes, self.docs, size)
            found, number = _equal(h, items.sorted)
            seed.append(number)
            at.append(places[found])
        return np.concatenate(at or [np.zeros(0, int)]), np.concatenate(seed or [np.zeros(0, int)])

    def close_words(self, items: Items, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, from, to): places where enough chosen words of an item stand together."""
        at, number = _equal(self.hashes, items.single)
        owner = items.single_owner[number]
        reach = _reach(items.lengths, least)
        # One axis for all items, with more room between them than any alignment takes.
        room = len(self.hashes) + int(reach.max(initial=0)) + 1
        order = np.argsort(owner * room + at, kind="stable")
        at, owner = at[order], owner[order]
        last = np.arange(len(at)) + items.due[owner] - 1
        ok = last < len(at)
        last = np.minimum(last, max(0, len(at) - 1))
        ok &= owner[last] == owner
        ok &= (at[last] - at < reach[owner]) & (self.docs[at[last]] == self.docs[at])
        start, end, owner = at[ok], at[last[ok]], owner[ok]
        doc, reach = self.docs[start], reach[owner]
        low = np.maximum(end - reach + 1, self.begin[doc])
        high = np.minimum(start + reach, self.begin[doc + 1])
        # Neighbours whose surroundings overlap are one place.
        new = np.ones(len(low), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
        first = np.flatnonzero(new)
        return doc[first], owner[first], low[first], high[np.append(first[1:], len(new))[: len(first)] - 1]


def _equal(asked: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `asked`, position in the sorted `known`), a pair for each equal value."""
    low = np.searchsorted(known, asked, "left")
    found = np.flatnonzero(low < len(known))
    found = found[known[low[found]] == asked[found]]
    low = low[found]
    many = np.searchsorted(known, asked[found], "right") - low
    before = np.cumsum(many) - many
    return np.repeat(found, many), np.repeat(low - before, many) + np.arange(many.sum())


def _reach(n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Words of a text that an alignment of this share takes at most: see `_may_reach`."""
    return n + (2 * n * np.maximum(0.0, 1 - least) + 1e-9).astype(np.int64)


def align(items: np.ndarray, item_lengths: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, end in the text) for many pairs at once.

    Rows are padded with values that match nothing.  Gaps along the text are a running maximum,
    so the loop runs over the words of the items only.
    """
    n, width = texts.shape
    ramp = np.arange(width) * -OTHER
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        live = i < item_lengths
        step = np.where(texts == items[:, i : i + 1], MATCH, OTHER)
        here = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + OTHER), 0)
        here = np.maximum(here, np.maximum.accumulate(here + ramp, axis=1) - ramp)
        here[~live] = 0
        top = here.argmax(axis=1)
        score = here[np.arange(n), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
        above[:, 1:] = here
    return best, end


def _chunks(widths: np.ndarray, cells: int = 400_000) -> Iterator[np.ndarray]:
    """Pairs of similar width, together of bounded size (a single one may be larger)."""
    order = np.argsort(widths, kind="stable")
    while len(order):
        fits = np.arange(1, len(order) + 1) * widths[order] <= cells
        n = max(1, int(fits.sum()))
        yield order[:n]
        order = order[n:]


def _may_reach(words: np.ndarray, item: np.ndarray, least: float, due: float | None = None) -> bool:
    """Whether a local alignment of the item within the words may reach `least`.

    With m matches and e other steps 2m - e >= 2 least n, so m >= least n, and as m <= n there are
    at most 2n (1 - least) words of the text between them.  `due` may ask for more words.
    """
    n = len(item)
    known = np.concatenate([[0], np.cumsum(np.isin(words, item))])
    span = min(len(words), n + int(2 * n * max(0.0, 1 - least)) + 1)
    return bool((known[span:] - known[: len(known) - span]).max() >= (due or least * n) - 1e-9)


def _seeded(part: Slice, items: Items, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, item, from, to, hits): what surrounds groups of seeds that may be leaks."""
    at, seed = part.hits(items)
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    owner = items.owner[seed]
    doc = part.docs[at]
    # Hits of one document and item whose diagonals lie within an item's length are one group.
    diagonal = at - items.place[seed]
    order = np.lexsort((diagonal, owner, doc))
    doc, owner, diagonal, rare = doc[order], owner[order], diagonal[order], items.rare[seed[order]]
    length = items.lengths[owner]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] - diagonal[:-1] > length[1:])
    first = np.flatnonzero(new)
    hits = np.diff(np.append(first, len(new)))
    rare = np.logical_or.reduceat(rare, first)
    doc, owner = doc[first], owner[first]
    low, high = diagonal[first], diagonal[np.append(first[1:], len(new)) - 1]
    length = length[first]
    # The margin holds as many added words as an alignment can have.
    reach = _reach(length, least[owner])
    low = np.maximum(low - reach, part.begin[doc])
    high = np.minimum(high + length + reach, part.begin[doc + 1])
    asked = rare.copy()
    for g in np.flatnonzero(~rare):
        asked[g] = _may_reach(part.hashes[low[g] : high[g]], items.words[owner[g]], least[owner[g]])
    return tuple(x[asked] for x in (doc, owner, low, high, hits))


def _seedless(part: Slice, items: Items, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, item, from, to, hits): places that may be leaks without a seed."""
    if not len(items.single):
        return (np.zeros(0, np.int64),) * 5
    doc, owner, low, high = part.close_words(items, least)
    due = [words_due(len(w), x) for w, x in zip(items.words, least, strict=True)]
    asked = np.array(
        [
            _may_reach(part.hashes[a:b], items.words[i], least[i], due[i])
            for a, b, i in zip(low.tolist(), high.tolist(), owner.tolist(), strict=True)
        ],
        bool,
    )
    return (*(x[asked] for x in (doc, owner, low, high)), np.zeros(int(asked.sum()), np.int64))


def leaks_of(part: Slice, items: Items, least: float, short: int = SHORT) -> list[tuple]:
    """(document, item, share of the full score, last word, hits) of every leak."""
    shares = items.least(least, short)
    found = zip(_seeded(part, items, shares), _seedless(part, items, shares), strict=True)
    doc, owner, low, high, hits = (np.concatenate(x) for x in found)
    length = items.lengths[owner]
    best: dict[tuple, tuple] = {}
    for chunk in _chunks(high - low):
        width, deep = int((high - low)[chunk].max()), int(length[chunk].max())
        # Padding must match nothing: 1 in texts, 2 in items, and no word hashes to either.
        texts = np.ones((len(chunk), width), np.uint64)
        goals = np.full((len(chunk), deep), 2, np.uint64)
        for row, g in enumerate(chunk):
            texts[row, : high[g] - low[g]] = part.hashes[low[g] : high[g]]
            goals[row, : length[g]] = items.words[owner[g]]
        score, end = align(goals, length[chunk], texts)
        share = score / (MATCH * length[chunk])
        for row in np.flatnonzero(share >= shares[owner[chunk]] - 1e-9):
            g = chunk[row]
            last = int(low[g] + end[row] - part.begin[doc[g]])
            key = (int(doc[g]), int(owner[g]))
            found = (float(share[row]), last, int(hits[g]))
            best[key] = max(best.get(key, found), found)
    return [(*key, *found) for key, found in sorted(best.items())]


def _count_seeds(docs: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """How often each seed of the block, and each of its words, stands in the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        n = len(known.sorted)
        counts = np.zeros(n + len(known.known), np.int64)
        for batch in batches:
            for part in tg.cut(batch, 0):
                texts = Slice(part.column(0))
                counts[:n] += np.bincount(texts.hits(known)[1], minlength=n)
                counts[n:] += np.bincount(_equal(texts.hashes, known.known)[1], minlength=len(counts) - n)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[seen])], names=["seed", "n"]
        )

    found = docs.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(items.sorted) + len(items.known), np.int64)
    # At most one row per seed and word of the block.
    for row in found.collect():
        counts[row["seed"]] = row["n"]
    return counts[: len(items.sorted)], counts[len(items.sorted) :]


def _rare(items: Items, counts: np.ndarray, factor: float) -> np.ndarray:
    """Seeds at most `factor` times as frequent as the median seed of their item."""
    order = np.lexsort((counts, items.owner))
    begin = np.searchsorted(items.owner[order], np.arange(len(items.ids) + 1))
    middle = np.minimum((begin[:-1] + begin[1:]) // 2, max(0, len(counts) - 1))
    median = np.maximum(counts[order][middle], 1) if len(counts) else np.ones(len(items.ids))
    return counts <= factor * median[items.owner]


def _blocks(
    docs: DataFrame, items: DataFrame, least: float, short: int, factor: float, block: int
) -> Iterator[Items]:
    """The items, a block of bounded size at a time, with what is rare in `docs` (t) marked."""
    named = stored(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")),
        "benchmark-items",
    )
    n_blocks = max(1, -(-named.count() // block))
    for number in range(n_blocks):
        own = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == number)
        rows = own.orderBy("item_id", "text").collect()
        held = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        seeds, words = _count_seeds(docs.select("t"), held)
        held.rare = _rare(held, seeds, factor)
        held.choose_words(words, held.least(least, short))
        yield held


def find_leaks(
    docs: DataFrame,
    text: str,
    keep: list[str],
    items: DataFrame,
    least: float = 0.5,
    factor: float = 4.0,
    block: int = 20_000,
    short: int = SHORT,
) -> DataFrame:
    """`keep` of every leaking document with item_id, score, last_word and n_seeds.

    items: columns item_id (whole numbers) and text.
    """
    asked = docs.select(F.col(text).alias("t"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keep)))
    schema = with_fields(
        docs.select(*keep),
        {"item_id": "long", "score": "double", "last_word": "long", "n_seeds": "long"},
    )
    names = schema.fieldNames()

    def of_block(held: Items) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for part in tg.cut(batch, 0):
                    found = leaks_of(Slice(part.column(0)), known, least, short)
                    if not found:
                        continue
                    doc, item, score, last, hits = zip(*found, strict=True)
                    take = pa.array(doc, pa.int64())
                    columns = [part.column(i + 1).take(take) for i in range(len(keep))]
                    columns += [
                        pa.array([known.ids[i] for i in item], pa.int64()),
                        pa.array(score, pa.float64()),
                        pa.array(last, pa.int64()),
                        pa.array(hits, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        return asked.mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, map(of_block, _blocks(asked, items, least, short, factor, block)))


def without_leaks(
    docs: DataFrame,
    text: str,
    items: DataFrame,
    least: float = 0.5,
    factor: float = 4.0,
    block: int = 20_000,
    short: int = SHORT,
) -> DataFrame:
    """The documents that leak no item of `short` words or more, all columns, without a shuffle."""
    schema, place = docs.schema, docs.columns.index(text)

    def drop(docs: DataFrame, held: Items) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for part in tg.cut(batch, place):
                    clean = np.ones(len(part), bool)
                    found = leaks_of(Slice(part.column(place)), known, least, short)
                    clean[[d for d, i, *_ in found if known.lengths[i] >= max(short, SEED)]] = False
                    yield part.filter(pa.array(clean))

        return docs.mapInArrow(run, schema)

    asked = docs.select(F.col(text).alias("t"))
    return reduce(drop, list(_blocks(asked, items, least, short, factor, block)), docs)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) pair that leaks, with its alignment score."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return find_leaks(docs, "text", ["doc_id"], items)
