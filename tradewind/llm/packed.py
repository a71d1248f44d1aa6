"""Documents packed in chunks, and the exchange of a chunk's keys with buckets of all keys.

Some questions (does this string occur anywhere else? how often does the corpus hold this word?)
are asked for every position of every text.  A shuffled row per position would be many times
the text.  Instead about a megabyte of texts is one chunk, a stored row; a chunk asks about each
distinct key once, in sorted arrays, one array per bucket of the key space, and gets one small
answer per key back in the same order.  A key that stands everywhere is asked once per chunk,
so there are no hot keys, and a bucket's size follows from the number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textgrid as tg
from .common import stored

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 16
# Bytes of text per bucket of keys.
BUCKET_BYTES = 16 << 20


def squeeze(data: bytes | np.ndarray, level: int = 1) -> bytes:
    """zstd, with the length in front."""
    data = data.tobytes() if isinstance(data, np.ndarray) else data
    codec = pa.Codec("zstd", compression_level=level)
    return len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True)


def unsqueeze(data: bytes, kind=np.uint8) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), kind)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys: byte by byte, so that the slow leading bytes stand together."""
    return squeeze(np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8).T))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    planes = unsqueeze(data).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def pack(
    docs: DataFrame, text: str, keep: list[str], chunk_bytes: int = CHUNK_BYTES, *, level: int = 1
) -> DataFrame:
    """(chunk, bytes, offsets, blob, one array k0, k1, ... per column of keep), stored.

    A text is never cut: a longer one is a chunk of its own.  level: of the blob's compression.
    """
    asked = docs.select(F.col(text).alias("text"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keep)))
    names = [f"k{i}" for i in range(len(keep))]
    lists = ", ".join(f"{n} array<{asked.schema[n].dataType.simpleString()}>" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            nonlocal number
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            raw, offsets = tg.flat(whole.column(0))
            columns = [pa.array([number]), pa.array([len(raw)]),
                       pa.array([squeeze(offsets)], pa.binary()), pa.array([squeeze(raw, level)], pa.binary())]
            for k in names:
                values = whole.column(k)
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "bytes", "offsets", "blob", *names])

        size = 0
        for batch in batches:
            for part in tg.cut(batch, 0, chunk_bytes // 4):
                held.append(part)
                size += len(tg.flat(part.column(0))[0])
                if size >= chunk_bytes or sum(map(len, held)) >= CHUNK_ROWS:
                    yield packed()
                    size = 0
        if held:
            yield packed()

    schema = f"chunk long, bytes long, offsets binary, blob binary, {lists}"
    return stored(asked.mapInArrow(run, schema), "packed")


def texts_of(offsets: bytes, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text begins) of a chunk."""
    return unsqueeze(blob), unsqueeze(offsets, np.int64)


def bucket_number(total_bytes: int) -> int:
    return max(12, -(-total_bytes // BUCKET_BYTES))


def hash_buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Even ranges of the sorted 64-bit key space: where each bucket begins in the keys."""
    edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]])


QUESTION = "bucket int, chunk long, keys binary, extra binary"
ANSWER = "chunk long, bucket int, answer binary"


def questions(chunk: int, begins: np.ndarray, keys: np.ndarray, extra: Callable[[slice], bytes]):
    """Rows of QUESTION for a chunk's sorted keys; begins: of the buckets, and the end."""
    for b in range(len(begins) - 1):
        own = slice(int(begins[b]), int(begins[b + 1]))
        if own.stop > own.start:
            yield b, chunk, squeeze_sorted(keys[own]), extra(own)


def question_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["bucket", "chunk", "keys", "extra"],
    )


def answered(
    asked: DataFrame,
    answer: Callable[[list[np.ndarray], list[bytes], list[int]], list[bytes]],
    summary: Callable[[list[np.ndarray], list[bytes]], bytes] | None = None,
) -> DataFrame:
    """The rows of ANSWER to rows of QUESTION, a bucket at a time.

    answer: the arrays of keys, the extras and the chunks of a bucket -> an answer per chunk.
    summary: what a bucket says as a whole, in a row with chunk -1.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        keys, extras = [unsqueeze_sorted(k) for k in rows["keys"]], list(rows["extra"])
        chunks, found = rows["chunk"].tolist(), answer(keys, extras, rows["chunk"].tolist())
        if summary is not None:
            chunks, found = [*chunks, -1], [*found, summary(keys, extras)]
        return pd.DataFrame({"chunk": chunks, "bucket": rows["bucket"].iloc[0], "answer": found})

    return asked.groupBy("bucket").applyInPandas(run, ANSWER)


def per_chunk(packed: DataFrame, answers: DataFrame, run: Callable[[pd.Series, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """run(the chunk's row, its answers by bucket) for every chunk."""

    def group(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return run(left.iloc[0], right.sort_values("bucket", kind="stable"))

    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(group, schema)
