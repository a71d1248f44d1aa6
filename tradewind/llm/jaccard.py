"""N-gram Jaccard self-join, size-aware.

Documents are sets of hashed word shingles; two link when 100 * |A & B| >= share * |A | B|.
Tokens have one global order, rare before frequent.  A set of n tokens shares at least
c = ceil(share * n / 100) of them with any partner, so partners meet in the first n - c + k
tokens k times.  Frequencies are counted over all texts: chunks of them ask bucket by bucket
(`packed`) for the number of each token, cut to CELLS cells per byte of text, so that the
share of tokens that fall together is small at every size.  A token that only one text has leads
nowhere and gets no list.  The join is size-aware: small sets enumerate the fixed-size subsets (pairs,
k = 2) of those tokens, large ones scan inverted lists of single tokens (k = 1); where small
ends is chosen by cost, from the sizes and the mean length of a list.  A small set that could
link to a large one is in both.

Lists are worked off in rounds, so that a list of many copies gives no quadratic number of
candidates.  First every set of a list is compared with the list's hub; links so found make
components (each set by its closest hub).  Then, in lists that still hold several components,
each set is compared with its closest partner in another one, twice; in the end all pairs
between different components are.
All this stands behind exact bounds (sizes, and parity bitmaps whose distance never exceeds the
sets' own); only pairs that pass leave the task.  Two sets of one component need no comparing:
the result is the component.  Every candidate is verified on the whole sets.

What is held per task or sent to all is bounded: the filter of candidate sets has a fixed size
(it steers cost, never results).  Steps are removed from the scratch folder when the last reader
is done.

Defined results: a null or empty text and one without words has an empty set and its own
component; equal sets always link; repeated rows get equal results; null ids never name a
component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed as pk
from . import textgrid as tg
from .common import fresh, steps_of, stored, table, with_fields
from .components import components

SHINGLE = 4
SHARE = 85
# Cells of the frequency count for every byte of text; a text has a token for about six bytes.
CELLS = 4
CHUNK_BYTES = 3 << 19
FILTER_BITS = 24
# Parity bitmaps have many cells for large sets and few for sets up to FEW_CELLS elements.
BITMAP_WORDS, SHORT_WORDS = 32, 8
EARLY_LISTS = 8
FEW_CELLS = 600
# Rows whose bitmaps are counted at once.
BITMAP_ROWS = 512


@dataclass(frozen=True)
class Rule:
    """When sets of shingles link: 100 * |A & B| >= share * |A | B|."""

    shingle: int = SHINGLE
    share: int = SHARE

    @property
    def alone(self) -> int:
        """Sets up to this size link to equal sets only."""
        return next(n for n in range(1, 200) if 100 * (n + 1) >= self.share * (n + 2))

    def least_overlap(self, n):
        return -(-self.share * n // 100)

    def may_link(self, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n_a, n_b).astype(np.int64), np.maximum(n_a, n_b).astype(np.int64)
        return small * 100 >= large * self.share

    def near_enough(self, apart: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Sets that link have |A xor B| <= (100 - share) / (100 + share) * (|A| + |B|)."""
        return apart * (100 + self.share) <= (100 - self.share) * (n_a + n_b)


def sets_of(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text of each hash, size per text): sorted sets, one text after the other."""
    n = len(offsets) - 1
    starts, ends, docs = tg.words(tg.LOWER[raw], offsets)
    hashes = tg.Ranges(tg.LOWER[raw]).hashes(starts, ends)
    at, h = tg.grams(hashes, docs, shingle)
    all_h, all_d = [h], [docs[at]]
    counts = np.bincount(docs, minlength=n)
    for few in range(1, shingle):
        # Fewer words than a shingle: the whole sequence is the one element.
        at, h = tg.grams(hashes, docs, few)
        own = counts[docs[at]] == few
        all_h.append(tg.mix(h[own] + np.uint64(few)))
        all_d.append(docs[at][own])
    h, d = np.concatenate(all_h), np.concatenate(all_d)
    order = np.argsort(h)
    order = order[np.argsort(_narrow(d[order], n), kind="stable")]
    h, d = h[order], d[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[first], d[first], np.bincount(d[first], minlength=n)


def _narrow(values: np.ndarray, limit: int) -> np.ndarray:
    """Small integers in the type that numpy sorts in linear time."""
    return values.astype(np.uint16) if limit < 1 << 16 else values


def set_ids(h: np.ndarray, d: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, the same for equal sets."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(tg.mix(h ^ tg.U64(0xD6E8FEB86659FD93)), out=sums[1:])
    ends = np.cumsum(sizes)
    return tg.mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64) * tg._STEP)


def _chunk_sets(row: dict, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = pk.texts_of(row["offsets"], row["blob"])
    return sets_of(raw, offsets, shingle)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """Chunks one by one: a batch of them may be large."""
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1)
            yield {n: row.column(n)[0].as_py() for n in ("chunk", "offsets", "blob")}, row


def _survey(chunks: DataFrame, keep: list[str], rule: Rule) -> DataFrame:
    """(keep, n, id, bitmap) of every row, stored."""
    own = [f"k{i}" for i in range(len(keep))]
    fields = ", ".join(f"k{i} {chunks.schema[f'k{i}'].dataType.elementType.simpleString()}" for i in range(len(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in _rows_of(batches):
            h, d, sizes = _chunk_sets(row, rule.shingle)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).flatten() for k in own), pa.array(sizes),
                 pa.array(set_ids(h, d, sizes).view(np.int64)), pa.array(_bitmaps(h, d, sizes), pa.binary())],
                names=[*own, "n", "id", "bitmap"],
            )

    found = stored(chunks.mapInArrow(run, f"{fields}, n long, id long, bitmap binary"), "jaccard-survey")
    return found.select(*(F.col(o).alias(k) for o, k in zip(own, keep, strict=True)), "n", "id", "bitmap")


def _cells(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> tg.U64(64 - bits)


def _asked(h: np.ndarray, d: np.ndarray, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which texts are the first of their set in the chunk, the cells of those, how often each)."""
    ids = set_ids(h, d, sizes)
    first = np.zeros(len(ids), bool)
    first[np.unique(ids, return_index=True)[1]] = True
    cells, counts = np.unique(_cells(h[first[d]], bits), return_counts=True)
    return first, cells, counts


def _frequencies(chunks: DataFrame, rule: Rule, bits: int, n_buckets: int) -> DataFrame:
    """Rows of ANSWER, stored: per cell of a chunk the binary order of magnitude of its count.

    The row with chunk -1 says of a bucket how many cells that occur more often it has, and how
    often they occur.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _ in _rows_of(batches):
            _, cells, counts = _asked(*_chunk_sets(row, rule.shingle), bits)
            # Cells as the leading bits of keys: buckets are even ranges of those.
            keys = cells << tg.U64(64 - bits)
            begins = pk.hash_buckets(keys, n_buckets)
            yield pk.question_batch(
                list(pk.questions(row["chunk"], begins, keys, lambda own, c=counts: pk.squeeze(c[own].astype(np.uint32))))
            )

    def count(keys: list[np.ndarray], extras: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cells, own = np.unique(np.concatenate(keys), return_inverse=True)
        seen = np.concatenate([pk.unsqueeze(x, np.uint32) for x in extras])
        return cells, own, np.bincount(own, weights=seen).astype(np.int64)

    def answer(keys, extras, _):
        _, own, total = count(keys, extras)
        levels = np.ceil(np.log2(total + 1)).astype(np.uint8)[own]
        edges = np.cumsum([len(k) for k in keys])[:-1]
        return [pk.squeeze(part) for part in np.split(levels, edges)]

    def summary(keys, extras):
        _, _, total = count(keys, extras)
        more = total[total > 1]
        return f"{len(more)} {more.sum()}".encode()

    asked = chunks.select("chunk", "offsets", "blob").mapInArrow(ask, pk.QUESTION)
    return stored(pk.answered(asked, answer, summary), "jaccard-frequencies")


def _mean_list(frequencies: DataFrame) -> float:
    """The mean length of the lists of tokens that occur more than once."""
    said = F.split(F.col("answer").cast("string"), " ")
    rows = frequencies.where("chunk = -1").select(
        said[0].cast("long").alias("cells"), said[1].cast("long").alias("seen")
    )
    cells, seen = rows.agg(F.sum("cells"), F.sum("seen")).first()
    return (seen or 0) / max(1, cells or 0)


def choose_boundary(sizes: dict[int, int], list_length: float, rule: Rule = Rule()) -> int:
    """The largest small size: the one for which subsets and list scans cost least together.

    sizes: how many sets have each size.  A subset costs one entry; a token costs one entry and
    the scan of its list.
    """
    alone, share = rule.alone, rule.share
    order = sorted(n for n in sizes if n > alone)
    best, boundary = None, alone
    n = np.array(order, np.int64)
    many = np.array([sizes[k] for k in order], np.float64)
    prefix = n - rule.least_overlap(n) + 1
    subsets = many * (prefix + 1) * prefix / 2
    scans = many * prefix * (1 + list_length)
    for x in [alone, *order]:
        cost = subsets[n <= x].sum() + scans[n * 100 > x * share].sum()
        if best is None or cost < best:
            best, boundary = cost, x
        if prefix[n <= x].max(initial=0) > 64:
            break
    return boundary


def signatures(
    h: np.ndarray, d: np.ndarray, sizes: np.ndarray, level: np.ndarray, boundary: int, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text): tokens of inverted lists and pairs of small sets.

    level: the order of magnitude of each token's frequency; at 1 no other set has the token.
    """
    order = np.argsort(level, kind="stable")
    order = order[np.argsort(_narrow(d[order], len(sizes)), kind="stable")]
    h, d, shared = h[order], d[order], level[order] > 1
    begin = np.cumsum(sizes) - sizes
    rank = np.arange(len(h)) - begin[d]
    n = sizes[d]
    prefix = n - rule.least_overlap(n) + 1
    listed = shared & (rank < prefix) & (n > rule.alone) & (n * 100 > boundary * rule.share)
    sig, text = [h[listed]], [d[listed]]
    small = np.flatnonzero((sizes > rule.alone) & (sizes <= boundary))
    deep = sizes[small] - rule.least_overlap(sizes[small]) + 2
    for i in range(int(deep.max(initial=0))):
        for j in range(i + 1, int(deep.max())):
            own = small[deep > j]
            own = own[shared[begin[own] + i] & shared[begin[own] + j]]
            pair = tg.mix(h[begin[own] + i] + tg.U64(7)) * tg._STEP + h[begin[own] + j]
            sig.append(tg.mix(pair))
            text.append(own)
    return np.concatenate(sig), np.concatenate(text)


def _postings(chunks: DataFrame, frequencies: DataFrame, boundary: int, rule: Rule, bits: int) -> DataFrame:
    """(sig, id, n): each distinct set of a chunk once."""

    def run(row: pd.Series, answers: pd.DataFrame) -> pd.DataFrame:
        h, d, sizes = _chunk_sets(row, rule.shingle)
        ids = set_ids(h, d, sizes)
        first, cells, _ = _asked(h, d, sizes, bits)
        levels = np.concatenate([np.zeros(0, np.uint8), *(pk.unsqueeze(a) for a in answers["answer"])])
        own = first[d]
        h, d, sizes = h[own], d[own], np.where(first, sizes, 0)
        level = levels[np.searchsorted(cells, _cells(h, bits))]
        sig, text = signatures(h, d, sizes, level, boundary, rule)
        return pd.DataFrame({"sig": sig.view(np.int64), "id": ids[text].view(np.int64), "n": sizes[text].astype(np.int32)})

    texts = chunks.select("chunk", "offsets", "blob")
    return pk.per_chunk(texts, frequencies.where("chunk >= 0"), run, "sig long, id long, n int")


def _table_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    parts = list(batches)
    return [
        np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in parts] or [np.zeros(0, np.int64)])
        for k in names
    ]


def _runs(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, length) of each run of equal values."""
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(sig)))


def _hub_pairs(postings: DataFrame, rule: Rule) -> DataFrame:
    """kind 0: pairs (a, b) of a set and a hub of one of its lists; kind 1: (sig, id, n) rows
    of lists with three sets or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, ids, n = _table_of(batches, ["sig", "id", "n"])
        order = np.lexsort((ids, sig))
        sig, ids, n = sig[order], ids[order], n[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
        sig, ids, n = sig[new], ids[new], n[new]
        first, length = _runs(sig)
        many = np.repeat(length, length) > 1
        sig, ids, n, length = sig[many], ids[many], n[many], np.repeat(length, length)[many]
        long_lists = length > 2
        yield _rows(1, sig[long_lists], ids[long_lists], n[long_lists])
        pairs = []
        while len(sig):
            # Sets that cannot link to this hub by their size get another one.
            first, runs = _runs(sig)
            hub = np.repeat(first, runs)
            fits = rule.may_link(n, n[hub])
            fits[first] = False
            pairs.append(np.stack([ids[hub[fits]], ids[fits]]))
            rest = ~fits
            rest[first] = False
            sig, ids, n = sig[rest], ids[rest], n[rest]
        if pairs:
            a, b = np.unique(np.concatenate(pairs, axis=1), axis=1) if sum(p.shape[1] for p in pairs) else pairs[0]
            yield _rows(0, a, b, np.zeros(len(a), np.int32))

    return postings.repartition("sig").mapInArrow(run, "kind int, a long, b long, n int")


def _rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.astype(np.int64)),
         pa.array(b.astype(np.int64)), pa.array(n.astype(np.int32))],
        names=["kind", "a", "b", "n"],
    )


def _folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of SHORT_WORDS words: cells that fall together add up, and so do parities."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, SHORT_WORDS), axis=1)


def _bitmaps(h: np.ndarray, d: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Which cells hold an odd number of a set's hashes, for each set.

    Every cell in which two bitmaps differ holds an element of one set alone.
    """
    width, ends, out = 64 * BITMAP_WORDS, np.cumsum(sizes), []
    for k in range(0, len(sizes), BITMAP_ROWS):
        own = sizes[k : k + BITMAP_ROWS]
        part = slice(int(ends[k] - sizes[k]), int(ends[k + len(own) - 1]))
        cell = (h[part] >> tg.U64(7)).astype(np.int64) & (width - 1)
        cells = np.bincount((d[part] - k) * width + cell, minlength=len(own) * width)
        bits = np.packbits((cells & 1).astype(np.uint8).reshape(len(own), width), axis=1).view(np.uint64)
        short = _folded(bits)
        out += [(s if n <= FEW_CELLS else b).tobytes() for s, b, n in zip(short, bits, own, strict=True)]
    return out


class Bitmaps:
    """Stored bitmaps, long and short ones, to be compared row by row."""

    def __init__(self, stored_bits: list[bytes]):
        self.long = np.array([len(b) > 8 * SHORT_WORDS for b in stored_bits], bool)
        self.short = np.zeros((len(stored_bits), SHORT_WORDS), np.uint64)
        own = [b for b in stored_bits if len(b) == 8 * SHORT_WORDS]
        self.short[~self.long] = np.frombuffer(b"".join(own), np.uint64).reshape(-1, SHORT_WORDS)
        own = [b for b in stored_bits if len(b) > 8 * SHORT_WORDS]
        self.whole = np.frombuffer(b"".join(own), np.uint64).reshape(-1, BITMAP_WORDS)
        self.place = np.cumsum(self.long) - 1
        if len(own):
            self.short[self.long] = _folded(self.whole)

    def apart(self, i: np.ndarray, other: Bitmaps, j: np.ndarray) -> np.ndarray:
        """In how many cells rows i differ from rows j of the other."""
        out = np.bitwise_count(self.short[i] ^ other.short[j]).sum(axis=1).astype(np.int64)
        both = self.long[i] & other.long[j]
        if both.any():
            a, b = self.whole[self.place[i][both]], other.whole[other.place[j][both]]
            out[both] = np.bitwise_count(a ^ b).sum(axis=1)
        return out


def _near(pairs: DataFrame, marks: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that the bitmaps do not rule out, with their distance.  marks: id, n, bitmap."""
    for end in ("a", "b"):
        pairs = pairs.join(marks.toDF(end, f"n_{end}", f"m_{end}"), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (Bitmaps(batch.column(k).to_pylist()) for k in ("m_a", "m_b"))
            n_a, n_b = (batch.column(k).to_numpy() for k in ("n_a", "n_b"))
            rows = np.arange(len(batch))
            apart = a.apart(rows, b, rows)
            found = batch.select(["a", "b"]).append_column("apart", pa.array(apart))
            yield found.filter(pa.array(rule.near_enough(apart, n_a, n_b)))

    return pairs.mapInArrow(run, "a long, b long, apart long")


def _closest(pairs: DataFrame) -> DataFrame:
    """Of each set's pairs with smaller ids the closest one: no more pairs than sets.

    The others are not lost: later rounds see them if they still lie between components.
    """
    nearest = F.min(F.struct("apart", "a")).alias("nearest")
    return pairs.groupBy("b").agg(nearest).select("nearest.a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))


def _sets(chunks: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """(id, tokens) of the wanted sets, each once, stored.

    A filter of fixed size that knows the wanted ids goes to the tasks, so that few other sets
    leave them; the join then keeps the wanted ones.
    """
    spark = chunks.sparkSession
    cells = wanted.select(F.shiftrightunsigned("id", 64 - FILTER_BITS).alias("cell")).distinct()
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = cells.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    known = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    # At most 2^(FILTER_BITS - 6) rows, as arrays.
    found = words.toArrow()
    known[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        seen = np.zeros(0, np.uint64)
        for row, _ in _rows_of(batches):
            h, d, sizes = _chunk_sets(row, rule.shingle)
            ids = set_ids(h, d, sizes)
            cell = ids >> tg.U64(64 - FILTER_BITS)
            there = (bits[(cell >> tg.U64(6)).astype(np.int64)] >> (cell & tg.U64(63))) & tg.U64(1)
            _, first = np.unique(ids, return_index=True)
            new = np.zeros(len(ids), bool)
            new[first] = True
            pick = np.flatnonzero(new & (there > 0) & ~np.isin(ids, seen))
            seen = np.concatenate([seen, ids[pick]])
            ends = np.cumsum(sizes)
            own = [h[ends[k] - sizes[k] : ends[k]] for k in pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[pick].view(np.int64)), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["id", "tokens"],
            )

    found = chunks.select("chunk", "offsets", "blob").mapInArrow(run, "id long, tokens binary")
    found = found.dropDuplicates(["id"]).join(wanted.select("id").distinct(), "id", "left_semi")
    return stored(found, "jaccard-sets")


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets link, stored."""
    for end in ("a", "b"):
        named = sets.select(F.col("id").alias(end), F.col("tokens").alias(f"t_{end}"))
        pairs = pairs.join(named, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for k in range(len(batch)):
                x = np.frombuffer(batch.column("t_a")[k].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("t_b")[k].as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                links.append(100 * same >= rule.share * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    found = pairs.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long")
    return stored(found, "jaccard-links")


def _torn_lists(lists: DataFrame) -> DataFrame:
    """The rows (sig, id, n, root) of lists that hold several components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _table_of(batches, ["sig", "id", "n", "root"])
        if not len(columns[0]):
            return
        order = np.argsort(columns[0], kind="stable")
        sig, ids, n, root = (c[order] for c in columns)
        first, length = _runs(sig)
        torn = np.minimum.reduceat(root, first) < np.maximum.reduceat(root, first)
        keep = np.repeat(torn, length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[keep].astype(k)) for c, k in ((sig, np.int64), (ids, np.int64), (n, np.int32), (root, np.int64))],
            names=["sig", "id", "n", "root"],
        )

    return lists.repartition("sig").mapInArrow(run, "sig long, id long, n int, root long")


def _cross_pairs(lists: DataFrame, nearest: bool, rule: Rule) -> DataFrame:
    """Pairs of one list and of different components that pass the bounds.

    nearest: only the closest such partner of each set, at most a row per set and list.
    lists: sig, id, n, root, bitmap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, ids, n, root, bits = _table_of(batches, ["sig", "id", "n", "root", "bitmap"])
        if not len(sig):
            return
        order = np.lexsort((n, sig))
        sig, ids, n, root = sig[order], ids[order], n[order].astype(np.int64), root[order]
        bits = Bitmaps(list(bits[order]))
        first, length = _runs(sig)
        out = []
        for begin, size in zip(first.tolist(), length.tolist(), strict=True):
            for i in range(begin, begin + size - 1):
                # Sorted by size: partners reach up to n / share.
                stop = int(np.searchsorted(n[i + 1 : begin + size] * rule.share, n[i] * 100, "right")) + i + 1
                j = np.arange(i + 1, stop)
                j = j[root[j] != root[i]]
                if not len(j):
                    continue
                apart = bits.apart(np.full(len(j), i), bits, j)
                good = rule.near_enough(apart, n[j], n[i])
                j, apart = j[good], apart[good]
                if nearest and len(j):
                    least = int(apart.argmin())
                    j, apart = j[[least]], apart[[least]]
                out.append(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), apart]))
        if out:
            columns = np.unique(np.concatenate(out, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "apart"])

    return lists.repartition("sig").mapInArrow(run, "a long, b long, apart long")


def _link_sets(chunks: DataFrame, sets_of_rows: DataFrame, rule: Rule) -> DataFrame:
    """All (a, b) links that the components of the sets need."""
    sizes = sets_of_rows.where(F.col("n") > 0).groupBy("n").agg(F.count_distinct("id").alias("sets"))
    # One row per set size.
    sizes = {r["n"]: r["sets"] for r in sizes.collect()}
    n_bytes = chunks.agg(F.sum("bytes")).first()[0] or 0
    bits = min(60, max(8, (CELLS * n_bytes).bit_length()))
    frequencies = _frequencies(chunks, rule, bits, pk.bucket_number(2 * n_bytes))
    boundary = choose_boundary(sizes, _mean_list(frequencies), rule)
    worked = stored(_hub_pairs(_postings(chunks, frequencies, boundary, rule, bits), rule), "jaccard-lists")
    pairs = worked.where("kind = 0").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    pairs = stored(pairs.distinct(), "jaccard-pairs")
    lists = worked.where("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("id"), "n")
    marks = sets_of_rows.where(F.col("n") > rule.alone).groupBy("id")
    marks = stored(marks.agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "jaccard-marks")
    near = stored(_near(pairs, marks, rule), "jaccard-near-pairs")
    tested = stored(_closest(near), "jaccard-closest-pairs")
    links = _verified(tested, _sets(chunks, rule, _ends(tested)), rule)
    # Close partners first: what they join need not be compared pair by pair any more.
    # A set is in many lists, and one list in EARLY_LISTS is enough for that; the last round
    # takes every list.
    for share in (EARLY_LISTS, EARLY_LISTS, 1):
        nearest = share > 1
        roots = components(links).withColumnRenamed("node", "id")
        some = lists.where(F.pmod("sig", F.lit(share)) == 0) if nearest else lists
        rooted = some.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        torn = stored(_torn_lists(rooted.select("sig", "id", "n", "root")), "jaccard-open-lists")
        marked = torn.join(marks.select("id", "bitmap"), "id")
        # Lists of two sets were worked off by their hub: what it left over is in `near`.
        left = near
        for end in ("a", "b"):
            left = left.join(roots.toDF(end, f"root_{end}"), end, "left")
            left = left.withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
        left = left.where("root_a <> root_b").select("a", "b", "apart")
        cross = _cross_pairs(marked, nearest, rule).unionAll(left).distinct()
        cross = cross.join(tested, ["a", "b"], "left_anti")
        cross = _closest(cross) if nearest else cross.select("a", "b")
        cross = stored(cross, "jaccard-cross-pairs")
        if cross.isEmpty():
            # The closest partners are all tested; the last round looks at the others too.
            continue
        links = links.unionAll(_verified(cross, _sets(chunks, rule, _ends(cross)), rule))
        tested = tested.unionAll(cross)
    return links


def _rooted(rows: DataFrame, keep: list[str], rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(keep, n, id) of every row of (text, keep), and (id, root) of every set that links."""
    chunks = pk.pack(rows, "text", keep, CHUNK_BYTES)
    sets_of_rows = _survey(chunks, keep, rule)
    links = _link_sets(chunks, sets_of_rows, rule)
    return sets_of_rows.drop("bitmap"), components(links).withColumnRenamed("node", "id")


def _lowest(sets_of_rows: DataFrame, roots: DataFrame, value) -> DataFrame:
    """(id, low): the smallest value among the rows of each set's component, stored."""
    # Equal sets first meet on the map side, then sets of one component.
    of_set = sets_of_rows.where("n > 0").groupBy("id").agg(F.min(value).alias("low"))
    of_set = of_set.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    of_set = stored(of_set, "jaccard-lowest-of-sets")
    lowest = stored(of_set.groupBy("root").agg(F.min("low").alias("lowest")), "jaccard-lowest")
    return stored(of_set.join(lowest, "root").select("id", F.col("lowest").alias("low")), "jaccard-named")


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with steps_of(docs.sparkSession) as steps:
        sets_of_rows, roots = _rooted(rows, ["doc_id"], rule)
        named = _lowest(sets_of_rows, roots, F.col("doc_id"))
        steps.keep(sets_of_rows, named)
    own = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return sets_of_rows.join(named, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def one_of_each(docs: DataFrame, text: str, doc_id: str, rule: Rule = Rule()) -> DataFrame:
    """The row with the smallest id of every component, all columns; rows without words stay.

    Rows are told apart by their id and a hash of all their columns; of rows that are equal in
    everything one stays.
    """
    tag = fresh("tag")
    tagged = docs.withColumn(tag, F.xxhash64(*docs.columns))
    rows = tagged.select(F.col(doc_id).alias("doc_id"), F.col(tag).alias("tag"), F.col(text).alias("text"))
    with steps_of(docs.sparkSession) as steps:
        sets_of_rows, roots = _rooted(rows, ["doc_id", "tag"], rule)
        chosen = _lowest(sets_of_rows, roots, F.struct("doc_id", "tag")).select("low.doc_id", "low.tag")
        chosen = chosen.unionAll(sets_of_rows.where("n = 0").select("doc_id", "tag")).distinct()
        chosen = stored(chosen.withColumnsRenamed({"doc_id": f"{tag}_id", "tag": f"{tag}_of"}), "jaccard-chosen")
        steps.keep(chosen)
    same = F.col(doc_id).eqNullSafe(F.col(f"{tag}_id")) & (F.col(tag) == F.col(f"{tag}_of"))
    return tagged.join(chosen, same, "left_semi").dropDuplicates([doc_id, tag]).drop(tag)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-copy component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))
