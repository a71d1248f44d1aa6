"""Periodic runs of words, by internal pattern matching.

A run is a stretch of a text with smallest period q (words q apart are equal) and at least
`times` * q and `least` words that no neighbouring word extends.  It is found from inside: of the
blocks of L words that begin at multiples of L (L a power of two), a run with q <= L < 2q holds a
whole one, and that block's occurrences in the window of L words to either side form a
progression whose difference is q, on one side at least, as `times` is four or more: a run of
four periods has a whole further period to the left or to the right of the block, and a word
that is no power occurs in its own square at the ends alone.  So the nearest occurrence on each
side is a candidate period, and extending it as far as it holds gives the run:

1. prefix doubling sorts the suffixes and leaves at every level the class of the block at every
   position; only suffixes that still share their class are sorted again;
2. a wavelet matrix over the suffix array answers for all blocks at once: the next and the last
   entry before a position in the block's range of suffixes (range successor, predecessor);
3. common extensions forth and back go down the levels of classes.  They compare classes, not
   hashes, so after words are numbered (by 64-bit hashes) everything is exact.

Texts of a slice of about a megabyte are handled together, each behind a word of its own that
equals nothing; a text is never cut, so a longer one is a slice alone, with about 250 bytes of
memory per word.  No row leaves its partition.

Defined results: a null text is empty; empty texts have no runs and collapse to the empty text.
A null seed (see `planted`) leaves the text alone.  Rows may repeat; other columns keep their
names and values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textgrid as tg
from .common import fresh, key_text, table, with_fields

LEAST_WORDS = 6
LEAST_TIMES = 4

RUNS = "array<struct<start:long,length:long,period:long>>"


class Suffixes:
    """The suffix array of a sequence that ends in a symbol found nowhere else.

    classes[k][i] is the first slot of the suffixes that begin with the 2**k symbols at i; slots
    are sorted as deep as two equal blocks of `depth` symbols need.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        order = np.argsort(symbols, kind="stable")
        keys, active = symbols[order], np.arange(len(symbols))
        own = np.zeros(len(symbols), np.int64)
        self.classes: list[np.ndarray] = []
        reach = 1
        while True:
            head = np.ones(len(keys), bool)
            head[1:] = keys[1:] != keys[:-1]
            group = np.cumsum(head) - 1
            own[order[active]] = active[head][group]
            self.classes.append(own.astype(np.int32 if len(own) < 1 << 31 else np.int64))
            active = active[np.bincount(group, minlength=1)[group] > 1]
            if not len(active) or 2 * reach > depth:
                break
            # An equal block holds no separator, so a symbol follows it.
            at = order[active]
            keys = own[at] * len(own) + own[at + reach]
            by = np.argsort(keys, kind="stable")
            order[active], keys = at[by], keys[by]
            reach *= 2
        self.order = order

    def forth(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on equal those from j on (i < j)."""
        return self._common(i, j, 1)

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i equal those before j (i < j)."""
        return self._common(i, j, -1)

    def _common(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        found = np.zeros(len(i), np.int64)

        def step(k: int) -> bool:
            shift = found if way > 0 else -found - (1 << k)
            a, b = i + shift, j + shift
            same = (a >= 0) & (self.classes[k][a] == self.classes[k][b])
            found[same] += 1 << k
            return bool(same.any())

        top = len(self.classes) - 1
        while step(top):
            pass
        for k in range(top - 1, -1, -1):
            step(k)
        return found


class WaveletMatrix:
    """Counts and quantiles of any slice of an array of small numbers, for many slices at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []
        for k in range(self.bits - 1, -1, -1):
            zero = (values >> k) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32 if len(values) < 1 << 31 else np.int64)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x."""
        found = np.zeros(len(lo), np.int64)
        for k, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = before[lo], before[hi]
            one = (x >> k) & 1 == 1
            found += np.where(one, b - a, 0)
            lo = np.where(one, before[-1] + lo - a, a)
            hi = np.where(one, before[-1] + hi - b, b)
        return found

    def ranked(self, lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value at a place (from 0) of the sorted values of [lo, hi)."""
        found = np.zeros(len(lo), np.int64)
        for k, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = before[lo], before[hi]
            one = place >= b - a
            place = np.where(one, place - (b - a), place)
            found += np.where(one, 1 << k, 0)
            lo = np.where(one, before[-1] + lo - a, a)
            hi = np.where(one, before[-1] + hi - b, b)
        return found


def candidates(suffixes: Suffixes, longest: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): the symbols from place on equal those a period later, a block long."""
    n = len(suffixes.order)
    matrix = None
    places, periods = [], []
    for k, own in enumerate(suffixes.classes):
        length = 1 << k
        if k and times * (length // 2 + 1) > longest:
            break
        if not k:
            # A block of one word: its window is its neighbour.
            at = np.flatnonzero(own[1:] == own[:-1])
            places.append(at)
            periods.append(np.ones(len(at), np.int64))
            continue
        size = np.bincount(own, minlength=n)
        at = np.arange(0, n, length)
        at = at[size[own[at]] > 1]
        if not len(at):
            break
        if matrix is None:
            matrix = WaveletMatrix(suffixes.order)
        lo = own[at].astype(np.int64)
        hi = lo + size[lo]
        rank = matrix.below(lo, hi, at)
        after, before = rank + 1 < hi - lo, rank > 0
        following = matrix.ranked(lo[after], hi[after], rank[after] + 1)
        previous = matrix.ranked(lo[before], hi[before], rank[before] - 1)
        place = np.concatenate([at[after], previous])
        period = np.concatenate([following, at[before]]) - place
        # Shorter periods have shorter blocks.
        fits = (period <= length) & (2 * period > length)
        places.append(place[fits])
        periods.append(period[fits])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(
    symbols: np.ndarray, longest: int, least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start and period.

    symbols: sequences of at most `longest` symbols, each followed by a symbol found nowhere else.
    """
    if times < LEAST_TIMES:
        raise ValueError(f"blocks show the periods of runs of {LEAST_TIMES} periods or more")
    if not len(symbols):
        return (np.zeros(0, np.int64),) * 3
    suffixes = Suffixes(symbols, longest // 2)
    place, period = candidates(suffixes, longest, times)
    start = place - suffixes.back(place, place + period)
    length = place + period + suffixes.forth(place, place + period) - start
    fits = (length >= least) & (length >= times * period)
    found = np.unique(np.stack([start[fits], period[fits], length[fits]], 1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def planted(n_words: np.ndarray, seed: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the word from which it repeats and the period, for texts whose seed asks for it.

    One text in ten gets a repetition: with g = seed // 10, from word a = g % n on it repeats
    p = 1 + (n - a) // (3 + g % 8) words.  Others: a = n.
    """
    g, some = seed // 10, np.maximum(n_words, 1)
    chosen = known & (seed % 10 == 0) & (n_words > 0)
    a = np.where(chosen, g % some, n_words)
    return a, 1 + (n_words - a) // (3 + g % 8)


def _scan(texts: pa.Array, seed: pa.Array | None, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """(runs, collapsed text) of every text."""
    raw, offsets = tg.flat(texts)
    starts, ends, docs = tg.words(raw, offsets)
    n_docs = len(texts)
    n_words = np.bincount(docs, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(n_words)])
    if seed is not None:
        values = seed.fill_null(0).to_numpy(zero_copy_only=False)
        a, p = planted(n_words, values, seed.is_valid().to_numpy(zero_copy_only=False))
        local, begin = np.arange(len(docs)) - first[docs], a[docs]
        local = np.where(local >= begin, begin + (local - begin) % p[docs], local)
        source = first[docs] + local
        starts, ends = starts[source], ends[source]

    _, ids = np.unique(tg.Ranges(raw).hashes(starts, ends), return_inverse=True)
    # Behind every text a symbol of its own; word w of text d stands at w + d.
    symbols = np.empty(len(ids) + n_docs, np.int64)
    at = np.arange(len(ids)) + docs
    symbols[at] = ids
    symbols[first[1:] + np.arange(n_docs)] = len(ids) + np.arange(n_docs)
    start, length, period = runs_of(symbols, int(n_words.max(initial=0)), least, times)

    owner = np.searchsorted(first[1:] + np.arange(n_docs), start, "right")
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.flatnonzero(np.cumsum(change)[at] == 0)

    own = start - first[owner] - owner
    fields = [pa.array(v, pa.int64()) for v in (own, length, period)]
    found = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))])
    runs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), found)
    return runs, _joined(raw, starts[kept], ends[kept], docs[kept], n_docs)


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, n_docs: int) -> pa.Array:
    """The words of every text with one space between them."""
    spaced = np.zeros(len(docs), np.int64)
    spaced[:-1] = docs[1:] == docs[:-1]
    sizes = ends - starts + spaced
    stops = np.cumsum(sizes)
    source = np.repeat(starts - (stops - sizes), sizes) + np.arange(int(stops[-1]) if len(stops) else 0)
    # The byte behind the last word of the buffer may not exist; it is overwritten in any case.
    out = raw[np.minimum(source, max(0, len(raw) - 1))] if len(source) else np.zeros(0, np.uint8)
    out[stops[spaced == 1] - 1] = 0x20
    lengths = np.bincount(docs, weights=sizes, minlength=n_docs).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.StringArray.from_buffers(
        n_docs, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())
    )


def attach_runs(
    docs: DataFrame,
    text: str,
    runs: str,
    collapsed: str,
    seed: str | None = None,
    least: int = LEAST_WORDS,
    times: int = LEAST_TIMES,
) -> DataFrame:
    """The rows with their runs (RUNS, in words from 0) and the text without their repetitions.

    The collapsed text keeps the first period of every run; words are joined by one space.
    seed: a long column that plants repetitions first, see `planted`.
    """
    names = docs.columns
    schema = with_fields(docs, {runs: RUNS, collapsed: "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tg.cut(batch, names.index(text)):
                own = part.column(names.index(seed)) if seed else None
                found = _scan(part.column(names.index(text)), own, least, times)
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*names, runs, collapsed])

    return docs.mapInArrow(run, schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after the repetitions that the contract plants by doc_id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seed, runs, collapsed = fresh("seed"), fresh("runs"), fresh("collapsed")
    docs = docs.withColumn(seed, F.crc32(key_text("doc_id").cast("binary")))
    found = attach_runs(docs, "text", runs, collapsed, seed)

    # Exact order of length / period: whole part, then the rest, which as a double is exact
    # enough to tell fractions with denominators below 2**26 apart.
    best = F.array_max(
        F.transform(
            runs,
            lambda r: F.struct(
                F.floor(r.length / r.period).alias("whole"),
                ((r.length % r.period) / r.period).alias("rest"),
                (-r.start).alias("start"),
                (-r.period).alias("period"),
                r.length.alias("length"),
            ),
        )
    )
    line = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    top = fresh("top")
    found = found.withColumn(top, best)
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        (-F.col(f"{top}.start")).alias("start"),
        F.col(f"{top}.length").alias("length"),
        (-F.col(f"{top}.period")).alias("period"),
        F.expr(f"1000 * {top}.length div -{top}.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
        F.sha2(F.col(collapsed), 256).alias("collapsed_sha256"),
    )
