"""Exact removal of repeated substrings, by sampled suffix sorting.

A byte is removed if a string of LENGTH bytes that covers it starts anywhere else too.  Sorting
all suffixes of a corpus would move LENGTH bytes per byte of text, so suffixes are taken in two
steps, both exact:

1. Anchors.  Every start is led by the position with the smallest hash of the GRAM bytes there
   among the next LENGTH - GRAM + 1 positions.  Equal strings have equal anchors, so starts led
   by an anchor whose gram stands nowhere else repeat nowhere.  Starts with one anchor form a
   segment; a segment whose whole string (all its windows) stands elsewhere repeats as a whole.
   Chunks ask buckets of anchors about both.
2. Suffixes.  What remains, starts of which some neighbours repeat and some do not (and one copy
   of each repeated segment that they could match), are suffixes to be sorted: by their leading
   8 bytes, then by a 64-bit fingerprint of all LENGTH bytes.  Splitters sampled from the corpus
   cut this order into ranges; each range is sorted by multikey quicksort, leading key first and
   ties by the next, and equal neighbours are repeated.  Splitters are whole keys, so equal
   suffixes never lie on two sides of a boundary and no comparison across one is left over.

Strings of equal fingerprint (and equal first bytes) count as equal: two different ones among
10^12 suffixes meet with a probability below one in a million.

Defined results: null and empty texts and texts shorter than LENGTH lose nothing; a repeated
row repeats all its strings; matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed as pk
from . import textgrid as tg
from .common import stored, table

LENGTH = 200
GRAM = 100
# The packed texts are stored once and cross two exchanges: a fifth less for some CPU.
BLOB_LEVEL = 6
# Anchor answers: alone; open (only some starts may repeat); repeated; repeated and its copy here
# stands for the others in step 2.
ALONE, OPEN, REPEATED, DELEGATE = range(4)


def segments(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(first start, last start, anchor hash, string hash) of every segment."""
    n = len(raw)
    lengths = np.diff(offsets)
    none = np.zeros(0, np.int64)
    if n < length or not (lengths >= length).any():
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    ranges = tg.Ranges(raw)
    grams = ranges.every(gram)
    # Leftmost minimum over the window of each start, by doubling.
    window = length - gram + 1
    value, at = (grams >> np.uint64(32)).astype(np.uint32), np.arange(len(grams), dtype=np.int32)
    have = 1
    while have < window:
        step = min(have, window - have)
        later = value[step:] < value[: len(value) - step]
        at = np.where(later, at[step:], at[: len(at) - step])
        value = np.where(later, value[step:], value[: len(value) - step])
        have += step
    whole = lengths >= length
    valid = np.zeros(n + 1, np.int8)
    np.add.at(valid, offsets[:-1][whole], 1)
    np.add.at(valid, offsets[1:][whole] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8)[: len(at)] > 0
    starts = np.flatnonzero(valid)
    led = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (led[1:] != led[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    low, high = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    # Anchors have small hashes by choice; mixed again they spread over all buckets.
    return low, high, tg.mix(grams[led[first]] + tg.U64(1)), ranges.hashes(low, high + length)


def _unique_pairs(f: np.ndarray, g: np.ndarray):
    """Distinct (f, g) in order, the pair number of each entry, and how often each stands."""
    order = np.lexsort((g, f))
    fs, gs = f[order], g[order]
    new = np.ones(len(f), bool)
    new[1:] = (fs[1:] != fs[:-1]) | (gs[1:] != gs[:-1])
    number = np.empty(len(f), np.int64)
    number[order] = np.cumsum(new) - 1
    return fs[new], gs[new], number, np.bincount(number, minlength=int(new.sum()))


def _anchor_questions(packed: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw, offsets = pk.texts_of(row["offsets"], row["blob"])
                _, _, f, g = segments(raw, offsets, length, gram)
                f, g, _, times = _unique_pairs(f, g)
                many = np.minimum(times, 2).astype(np.uint8)
                found = pk.questions(
                    row["chunk"], pk.hash_buckets(f, buckets), f,
                    lambda own, g=g, many=many: pk.squeeze(g[own].tobytes() + many[own].tobytes()),
                )
                yield pk.question_batch(found)

    return packed.select("chunk", "offsets", "blob").mapInArrow(run, pk.QUESTION)


def _answer_anchors(keys: list[np.ndarray], extras: list[bytes], chunks: list[int]) -> list[bytes]:
    lengths = [len(k) for k in keys]
    f = np.concatenate(keys)
    extra = [pk.unsqueeze(e) for e in extras]
    g = np.concatenate([e[: 8 * n].view(np.uint64) for e, n in zip(extra, lengths, strict=True)])
    times = np.concatenate([e[8 * n :] for e, n in zip(extra, lengths, strict=True)]).astype(np.int64)
    # Entries stand by chunk; a stable sort keeps the smallest chunk first in each pair.
    order = np.lexsort((g, f))
    fs, gs, ts = f[order], g[order], times[order]
    new_f = np.append(True, fs[1:] != fs[:-1])
    new_g = new_f | np.append(True, gs[1:] != gs[:-1])
    of_f, of_g = np.cumsum(new_f) - 1, np.cumsum(new_g) - 1
    total_f, total_g = np.bincount(of_f, ts), np.bincount(of_g, ts)
    single = total_g[of_g] < 2
    torn = np.bincount(of_f, single) > 0
    code = np.where(single, OPEN, np.where(torn[of_f] & new_g, DELEGATE, REPEATED))
    code[total_f[of_f] < 2] = ALONE
    out = np.empty(len(f), np.uint8)
    out[order] = code
    return [pk.squeeze(x) for x in np.split(out, np.cumsum(lengths)[:-1])]


def _suffixes(raw: np.ndarray, ranges: tg.Ranges, starts: np.ndarray, length: int):
    """(leading bytes as a number, fingerprint) of the suffixes."""
    lead = raw[starts[:, None] + np.arange(8)].view(">u8").reshape(-1).astype(np.uint64)
    return lead, ranges.hashes(starts, starts + length)


def _expand(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers of the closed intervals."""
    many = high - low + 1
    base = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) if len(low) else low
    return base + np.arange(many.sum())


def _sample_splitters(packed: DataFrame, length: int, n: int, chunks: int = 2000, each: int = 64):
    """n - 1 keys that cut the order of suffixes evenly, from at most chunks * each suffixes."""
    total = packed.count()
    rate = max(1, -(-total // chunks))
    some = packed.where(F.pmod(F.xxhash64("chunk"), F.lit(rate)) == 0).select("chunk", "offsets", "blob")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw, _ = pk.texts_of(row["offsets"], row["blob"])
                if len(raw) < length:
                    continue
                at = np.linspace(0, len(raw) - length, each).astype(np.int64)
                lead, mark = _suffixes(raw, tg.Ranges(raw), at, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead.view(np.int64)), pa.array(mark.view(np.int64))], names=["lead", "mark"]
                )

    rows = some.mapInArrow(run, "lead long, mark long").collect()
    lead = np.array([r["lead"] for r in rows], np.int64).view(np.uint64)
    mark = np.array([r["mark"] for r in rows], np.int64).view(np.uint64)
    order = np.lexsort((mark, lead))
    if not len(order):
        return lead, mark
    pick = order[(np.arange(1, n) * len(order)) // n]
    return lead[pick], mark[pick]


def _range_begins(lead: np.ndarray, mark: np.ndarray, splitters) -> np.ndarray:
    """Where each range begins among sorted suffix keys."""
    s_lead, s_mark = splitters
    low, high = np.searchsorted(lead, s_lead, "left"), np.searchsorted(lead, s_lead, "right")
    inner = [a + np.searchsorted(mark[a:b], m, "left") for a, b, m in zip(low, high, s_mark, strict=True)]
    return np.concatenate([[0], np.array(inner, np.int64), [len(lead)]])


def _answer_suffixes(keys: list[np.ndarray], extras: list[bytes], chunks: list[int]) -> list[bytes]:
    lengths = [len(k) for k in keys]
    lead = np.concatenate(keys)
    extra = [pk.unsqueeze(e) for e in extras]
    mark = np.concatenate([e[: 8 * n].view(np.uint64) for e, n in zip(extra, lengths, strict=True)])
    many = np.concatenate([e[8 * n :] for e, n in zip(extra, lengths, strict=True)]) > 1
    return [pk.squeeze(np.packbits(x)) for x in np.split(many | _equal_neighbours(lead, mark), np.cumsum(lengths)[:-1])]


def _equal_neighbours(lead: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Which keys stand more than once: multikey quicksort, the next key only within ties."""
    order = np.argsort(lead, kind="quicksort")
    sorted_lead = lead[order]
    tied = np.zeros(len(lead), bool)
    tied[1:] = sorted_lead[1:] == sorted_lead[:-1]
    tied[:-1] |= tied[1:]
    out = np.zeros(len(lead), bool)
    rest = order[tied]
    if len(rest):
        group = np.cumsum(np.append(True, lead[rest][1:] != lead[rest][:-1]))
        inner = np.lexsort((mark[rest], group))
        rest, group = rest[inner], group[inner]
        same = (mark[rest][1:] == mark[rest][:-1]) & (group[1:] == group[:-1])
        out[rest[1:][same]] = True
        out[rest[:-1][same]] = True
    return out


_STATE = "kind int, bucket int, chunk long, keys binary, extra binary"


def _suffix_questions(packed: DataFrame, anchors: DataFrame, length: int, gram: int, splitters) -> DataFrame:
    """kind 0: rows of QUESTION; kind 1: what each chunk keeps for the last step."""
    shared = packed.sparkSession.sparkContext.broadcast(splitters)

    def run(row: pd.Series, answers: pd.DataFrame) -> pd.DataFrame:
        raw, offsets = pk.texts_of(row["offsets"], row["blob"])
        low, high, f, g = segments(raw, offsets, length, gram)
        _, _, number, _ = _unique_pairs(f, g)
        codes = np.concatenate([pk.unsqueeze(a) for a in answers["answer"]] or [np.zeros(0, np.uint8)])
        code = codes[number] if len(number) else number
        sure = (code == REPEATED) | (code == DELEGATE)
        asked = (code == OPEN) | (code == DELEGATE)
        starts = _expand(low[asked], high[asked])
        lead, mark = _suffixes(raw, tg.Ranges(raw), starts, length)
        lead, mark, _, times = _unique_pairs(lead, mark)
        many = np.minimum(times, 2).astype(np.uint8)
        rows = [
            (0, b, c, k, e)
            for b, c, k, e in pk.questions(
                int(row["chunk"]), _range_begins(lead, mark, shared.value), lead,
                lambda own: pk.squeeze(mark[own].tobytes() + many[own].tobytes()),
            )
        ]
        sizes = np.array([sure.sum(), asked.sum()], np.int64)
        state = np.concatenate([sizes, low[sure], high[sure], low[asked], high[asked]])
        rows.append((1, -1, int(row["chunk"]), b"", pk.squeeze(state)))
        return pd.DataFrame(rows, columns=["kind", "bucket", "chunk", "keys", "extra"])

    return pk.per_chunk(packed.select("chunk", "offsets", "blob"), anchors, run, _STATE)


def remove_repeats(
    docs: DataFrame, text: str, keep: list[str], length: int = LENGTH, gram: int = GRAM, with_text: bool = False
) -> DataFrame:
    """`keep`, n_bytes, n_removed, n_spans and kept_sha256 of every text, and the kept bytes."""
    packed = pk.pack(docs, text, keep, level=BLOB_LEVEL)
    total = packed.agg(F.sum("bytes")).first()[0] or 0
    buckets = pk.bucket_number(total)
    anchors = pk.answered(_anchor_questions(packed, length, gram, buckets), _answer_anchors)
    splitters = _sample_splitters(packed, length, buckets)
    state = stored(_suffix_questions(packed, anchors, length, gram, splitters), "suffix-questions")
    suffixes = pk.answered(state.where("kind = 0").drop("kind"), _answer_suffixes)
    kept = state.where("kind = 1").select("chunk", "bucket", F.col("extra").alias("answer"))
    types = [packed.schema[f"k{i}"].dataType.elementType.simpleString() for i in range(len(keep))]
    fields = [f"k{i} {t}" for i, t in enumerate(types)]
    fields += ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    fields += ["kept binary"] * with_text

    def run(row: pd.Series, answers: pd.DataFrame) -> pd.DataFrame:
        raw, offsets = pk.texts_of(row["offsets"], row["blob"])
        # The state has bucket -1 and so comes first.
        held = pk.unsqueeze(answers["answer"].iloc[0], np.int64)
        n_sure, n_asked = held[:2]
        low, high, a_low, a_high = np.split(held[2:], np.cumsum([n_sure, n_sure, n_asked]))
        starts = _expand(a_low, a_high)
        lead, mark = _suffixes(raw, tg.Ranges(raw), starts, length)
        lead, mark, number, _ = _unique_pairs(lead, mark)
        begins = np.diff(_range_begins(lead, mark, splitters))
        said = [
            np.unpackbits(pk.unsqueeze(a), count=int(begins[b])).astype(bool)
            for a, b in zip(answers["answer"].iloc[1:], answers["bucket"].iloc[1:], strict=True)
        ]
        again = np.concatenate(said or [np.zeros(0, bool)])
        starts = starts[again[number]] if len(starts) else starts
        marks = np.zeros(len(raw) + 1, np.int32)
        np.add.at(marks, low, 1)
        np.add.at(marks, high + length, -1)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + length, -1)
        gone = np.cumsum(marks[:-1]) > 0
        n = len(offsets) - 1
        _, _, owner = tg.runs(gone, offsets)
        rest = raw[~gone].tobytes()
        left = np.concatenate([[0], np.cumsum(np.diff(offsets) - tg.counts_by_doc(gone, offsets))])
        pieces = [rest[left[i] : left[i + 1]] for i in range(n)]
        out = {f"k{i}": pd.Series(row[f"k{i}"], dtype=object) for i in range(len(keep))}
        out["n_bytes"] = np.diff(offsets)
        out["n_removed"] = tg.counts_by_doc(gone, offsets)
        out["n_spans"] = np.bincount(owner, minlength=n)
        out["kept_sha256"] = [hashlib.sha256(p).hexdigest() for p in pieces]
        if with_text:
            out["kept"] = pieces
        return pd.DataFrame(out)

    found = pk.per_chunk(packed, kept.unionAll(suffixes), run, ", ".join(fields))
    return found.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keep)})


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that the corpus repeats."""
    return remove_repeats(table(spark, sf_dir, "documents"), "text", ["doc_id"])
