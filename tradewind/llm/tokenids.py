"""Token ids of whole texts in binary files, and back.

Texts are sorted by id into ranges; the task of a range encodes them and writes one file:

  "TWS8IDS1"
  blocks, each: four 32-bit numbers (ids, words, escapes, crc32 of what follows), then the
    Simple-8b words and the escapes (`simple8b`); a block has BLOCK_IDS ids, the last may have fewer
  footer: per text its id, a byte that says whether that is null, and its number of ids; per block
    its offset in the file and its number of ids
  tail: four 64-bit numbers (texts, blocks, ids, offset of the footer), "TWS8IDS1"

All numbers are little-endian.  Block offsets let a reader begin anywhere; ids know nothing of
blocks, so a text may lie in several.  A table of the files (`manifest`, Parquet, one row per
file) holds the number of the first id of each; only files of finished tasks are in it, so what
a lost executor left behind is never read.  Readers stream some blocks at a time.

Encoding.  Byte-level vocabularies without a normaliser split texts before white space that
follows another character (`_pieces`); what stands between two such places is encoded alike
wherever it occurs.  So only the distinct pieces of a slice are encoded, in long strings that
the lengths of their tokens take apart again, and pieces with equal hashes are compared byte by
byte.  A worker remembers up to KNOWN_PIECES of them from slice to slice, which saves time and
decides nothing.  Other tokenizers encode every text as a whole.

Defined results: a null text is empty; an empty text has the end id alone; null ids come first;
texts with equal ids stand in the order of a hash of their text; strings of special tokens in a
text are ordinary text.  A damaged file stops the job with its name.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import simple8b
from . import textgrid as tg
from .common import stored, table
from .files import NewFile, file_system

MAGIC = b"TWS8IDS1"
BLOCK_IDS = 1024
# Bytes of text whose distinct pieces are encoded together.
PIECES_BYTES = (4 << 20) - (64 << 10)
KNOWN_PIECES = 1 << 20
# Bytes of one string given to the tokenizer, and blocks that a reader holds.
STRING_BYTES = 1 << 11
READ_BLOCKS = 1024

_BLOCK = struct.Struct("<4I")
_TAIL = struct.Struct("<4Q8s")
MANIFEST = "shard int, file string, n_texts long, n_ids long, n_bytes long"


class Encoder:
    """A tokenizer file; ids of many texts at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        self.by_pieces = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space", True) and not parts.get("normalizer")
            and not parts["model"].get("continuing_subword_prefix")
            and not parts["model"].get("end_of_word_suffix")
        )
        self._known = _Known()
        # A character of a byte-level token stands for a byte.
        vocabulary = self._tokenizer.get_vocab(False)
        self._bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self._bytes[number] = len(token)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each text has)."""
        if not self.by_pieces:
            found = self._ids([t or "" for t in texts.to_pylist()])
            counts = np.array([len(x) for x in found], np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *found]), counts
        raw, offsets = tg.flat(texts)
        starts = _pieces(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        docs = np.searchsorted(offsets, starts, "right") - 1
        counts, found = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint32)]
        window = starts // PIECES_BYTES
        edges = [0, *(np.flatnonzero(np.diff(window)) + 1).tolist(), len(starts)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                ids, sizes = self._slice(raw, starts[a:b], ends[a:b])
                found.append(ids)
                counts += np.bincount(docs[a:b], weights=sizes, minlength=len(counts)).astype(np.int64)
        return np.concatenate(found), counts

    def _slice(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of neighbouring pieces."""
        begin = int(starts[0])
        raw, starts, ends = raw[begin : int(ends[-1])], starts - begin, ends - begin
        hashes = tg.Ranges(raw).hashes(starts, ends)
        _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = ends - starts
        differ = _differ(raw, starts, sizes, raw, starts[first][same], sizes[first][same])
        # Pieces whose bytes differ from the first of their hash are distinct ones of their own.
        others = np.flatnonzero(differ)
        same[others] = len(first) + np.arange(len(others))
        first = np.concatenate([first, others])
        a, n, h = starts[first], sizes[first], hashes[first]

        slot = self._known.find(h, raw, a, n)
        new = np.flatnonzero(slot < 0)
        ids, counts = self._distinct(raw, a[new], a[new] + n[new])
        all_ids = np.concatenate([self._known.ids, ids])
        at, many = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        old = np.flatnonzero(slot >= 0)
        at[old], many[old] = self._known.at[slot[old]], self._known.counts[slot[old]]
        at[new], many[new] = len(self._known.ids) + np.cumsum(counts) - counts, counts
        self._known.learn(h[new], raw, a[new], n[new], ids, counts)

        counts = many[same]
        upto = np.cumsum(counts)
        source = np.repeat(at[same] - (upto - counts), counts) + np.arange(int(upto[-1]))
        return all_ids[source], counts

    def _distinct(self, raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of the pieces [a, b)."""
        data = raw.tobytes()
        # Pieces that begin with white space and end otherwise stay pieces in a row of them.
        chains = tg.SPACE[raw[a]] & _visible(raw[b - 1])
        chained, alone = np.flatnonzero(chains), np.flatnonzero(~chains)
        stops = np.cumsum((b - a)[chained])
        chunk = np.searchsorted(stops, np.arange(0, int(stops[-1]) if len(stops) else 0, STRING_BYTES), "left")
        chunk = np.unique(np.append(chunk, len(chained)))
        pieces = [data[x:y] for x, y in zip(a[chained].tolist(), b[chained].tolist(), strict=True)]
        encoded = self._ids([b"".join(pieces[x:y]).decode() for x, y in zip(chunk, chunk[1:], strict=False)])
        sizes = np.zeros(len(a), np.int64)
        if encoded:
            ends_at = np.cumsum(self._bytes[np.concatenate(encoded)])
            upto = np.searchsorted(ends_at, stops, "left") + 1
            if ends_at[-1] != stops[-1] or not (ends_at[upto - 1] == stops).all():
                raise ValueError("the tokens of a text do not add up to its bytes")
            sizes[chained] = np.diff(upto, prepend=0)
        single = self._ids([data[a[k] : b[k]].decode() for k in alone.tolist()])
        sizes[alone] = [len(x) for x in single]
        # Ids stand with those in rows first, then the others: bring them into the pieces' order.
        ids = np.concatenate([np.zeros(0, np.uint32), *encoded, *single])
        order = np.concatenate([chained, alone])
        at = np.zeros(len(a), np.int64)
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        begin = np.cumsum(sizes) - sizes
        return ids[np.repeat(at - begin, sizes) + np.arange(len(ids))], sizes


class _Known:
    """Pieces that were encoded before, by hash and bytes; starts anew when full."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        # Per hash (sorted) the number of its piece; per piece its bytes and ids.
        self._piece = np.zeros(0, np.int64)
        self._raw = np.zeros(0, np.uint8)
        self._starts = self._sizes = self.at = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, hashes: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        piece = np.where(self.hashes[slot] == hashes, self._piece[slot], -1)
        hit = np.flatnonzero(piece >= 0)
        own = piece[hit]
        differ = _differ(raw, starts[hit], sizes[hit], self._raw, self._starts[own], self._sizes[own])
        piece[hit[differ]] = -1
        return piece

    def learn(self, hashes, raw, starts, sizes, ids, counts) -> None:
        """Pieces that `find` did not know, in any order."""
        if len(self.hashes) + len(hashes) > KNOWN_PIECES:
            self.__init__()
        if len(hashes) > KNOWN_PIECES:
            return
        stops = np.cumsum(sizes)
        source = np.repeat(starts - (stops - sizes), sizes) + np.arange(int(stops[-1]) if len(stops) else 0)
        number = len(self._starts) + np.arange(len(hashes))
        self._starts = np.concatenate([self._starts, len(self._raw) + stops - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._raw = np.concatenate([self._raw, raw[source]])
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(hashes, kind="stable")
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self._piece = np.insert(self._piece, place, number[order])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _visible(raw: np.ndarray) -> np.ndarray:
    return (raw > 0x20) & (raw < 0x7F)


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and all white space behind a visible ASCII character.

    No token of a byte-level vocabulary reaches over such a place, and none looks over it.
    """
    begins = np.zeros(len(raw), bool)
    begins[1:] = tg.SPACE[raw[1:]] & _visible(raw[:-1])
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def _differ(raw, starts, sizes, other, other_starts, other_sizes) -> np.ndarray:
    """Which byte ranges differ from their counterparts in the other buffer."""
    wrong = sizes != other_sizes
    width = np.where(wrong, 0, sizes)
    stops = np.cumsum(width)
    n = int(stops[-1]) if len(stops) else 0
    kind = np.int32 if max(n, len(raw), len(other)) < 1 << 31 else np.int64
    inside = np.arange(n, dtype=kind)
    begins = stops - width
    a = raw[np.repeat((starts - begins).astype(kind), width) + inside]
    b = other[np.repeat((other_starts - begins).astype(kind), width) + inside]
    at = np.flatnonzero(a != b)
    wrong[np.searchsorted(stops, at, "right")] = True
    return wrong


class _Writer:
    """A file of ids, block by block."""

    def __init__(self, path: str):
        self._file = NewFile(path)
        self._file.write(MAGIC)
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self.n_ids = 0
        self._offsets: list[int] = []
        self._sizes: list[int] = []
        self._texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        values = keys.fill_null(0).to_numpy(zero_copy_only=False)
        self._texts.append((values.astype("<i8"), (~known).astype(np.uint8), counts.astype("<u8")))
        self._held.append(ids)
        self._n_held += len(ids)
        self.n_ids += len(ids)
        if self._n_held >= 64 * BLOCK_IDS:
            self._flush(self._n_held // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        held = np.concatenate(self._held) if self._held else np.zeros(0, np.uint32)
        words, n_words, escapes, n_escapes = simple8b.encode(held[:n], BLOCK_IDS)
        at = np.concatenate([[0], np.cumsum(n_words)]).tolist()
        also = np.concatenate([[0], np.cumsum(n_escapes)]).tolist()
        words, escapes = words.astype("<u8"), escapes.astype("<u8")
        for k in range(len(n_words)):
            size = min(BLOCK_IDS, n - k * BLOCK_IDS)
            body = words[at[k] : at[k + 1]].tobytes() + escapes[also[k] : also[k + 1]].tobytes()
            self._offsets.append(self._file.size)
            self._sizes.append(size)
            head = _BLOCK.pack(size, at[k + 1] - at[k], also[k + 1] - also[k], zlib.crc32(body))
            self._file.write(head + body)
        self._held, self._n_held = [held[n:]], len(held) - n

    def close(self) -> tuple[int, int]:
        """(texts, bytes)."""
        self._flush(self._n_held)
        footer, n_texts = self._file.size, sum(len(x[0]) for x in self._texts)
        for k in range(3):
            self._file.write(b"".join(x[k].tobytes() for x in self._texts))
        self._file.write(np.array(self._offsets, "<u8").tobytes() + np.array(self._sizes, "<u8").tobytes())
        self._file.write(_TAIL.pack(n_texts, len(self._sizes), self.n_ids, footer, MAGIC))
        self._file.close()
        return n_texts, self._file.size


class _Reader:
    """A file of ids: its texts, and its ids from some blocks at a time."""

    def __init__(self, path: str):
        system, place = file_system(path)
        self._path, self._file = path, system.open_input_file(place)
        size = self._file.size()
        tail = self._at(size - _TAIL.size, _TAIL.size) if size >= _TAIL.size else b""
        if tail[-8:] != MAGIC:
            raise ValueError(f"{path} is not a whole file of token ids")
        n, blocks, self.n_ids, footer, _ = _TAIL.unpack(tail)
        data = self._at(footer, size - _TAIL.size - footer)
        if len(data) != 17 * n + 16 * blocks:
            raise ValueError(f"{path} has a damaged footer")
        self.keys = np.frombuffer(data, "<i8", n)
        self.no_key = np.frombuffer(data, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64)
        self._offsets = np.append(np.frombuffer(data, "<u8", blocks, 17 * n), [footer]).astype(np.int64)
        self._sizes = np.frombuffer(data, "<u8", blocks, 17 * n + 8 * blocks).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        return self._file.read_at(size, offset)

    def ids(self) -> Iterator[np.ndarray]:
        for a in range(0, len(self._sizes), READ_BLOCKS):
            yield self._blocks(a, min(a + READ_BLOCKS, len(self._sizes)))

    def _blocks(self, a: int, b: int) -> np.ndarray:
        offsets = self._offsets[a : b + 1] - self._offsets[a]
        data = self._at(int(self._offsets[a]), int(offsets[-1]))
        heads = [_BLOCK.unpack_from(data, x) for x in offsets[:-1].tolist()]
        words, escapes = [], []
        for start, stop, (_, n_words, _, check) in zip(offsets, offsets[1:], heads, strict=False):
            body = data[start + _BLOCK.size : stop]
            if zlib.crc32(body) != check:
                raise ValueError(f"{self._path} is damaged at {int(self._offsets[a] + start)}")
            words.append(body[: 8 * n_words])
            escapes.append(body[8 * n_words :])
        _, n_words, n_escapes, _ = np.array(heads, np.int64).T
        return simple8b.decode(
            np.frombuffer(b"".join(words), "<u8"), n_words,
            np.frombuffer(b"".join(escapes), "<u8"), n_escapes, self._sizes[a:b],
        )

    def close(self) -> None:
        self._file.close()


def write_ids(docs: DataFrame, text: str, key: str, root: str, tokenizer: str, end: int = 0) -> None:
    """Encode every text with the tokenizer file, append the end id, and write by ascending key.

    tokenizer: a path that every executor can read.  Files and their manifest lie below root.
    """
    asked = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"),
        # Rows that repeat often can be split among files too.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "tie", "row"]
    ranged = asked.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = _encoder(tokenizer), None
        name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.tws8"
        for batch in batches:
            for part in tg.cut(batch, 1, PIECES_BYTES):
                if out is None:
                    out = _Writer(f"{root}/{name}")
                ids, counts = encoder.encode(part.column(1))
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end))
                out.add(part.column(0), ids, counts + 1)
        if out is not None:
            n_texts, n_bytes = out.close()
            row = [TaskContext.get().partitionId(), name, n_texts, out.n_ids, n_bytes]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MANIFEST.split(", ")])

    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """A row per file, with `start`, the number of its first id; one window over the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


_CHECKED = "key long, start long, n_tokens long, ids_crc32 long"
_WHOLE = "key long, start long, ids array<long>"


def _read(spark: SparkSession, root: str, schema: str, of) -> DataFrame:
    """of(reader, start of the file) -> batches, for every file; one file at a time and task."""
    files = stored(manifest(spark, root).select("file", "start"), "token-files")
    spread = files.repartition(max(1, files.count()), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = _Reader(f"{root}/{name}")
                yield from of(reader, start)
                reader.close()

    return spread.mapInArrow(run, schema)


def checksums(spark: SparkSession, root: str) -> DataFrame:
    """Per text: key, start (number of its first id), n_tokens, ids_crc32 of its 32-bit ids."""

    def of(reader: _Reader, start: int) -> Iterator[pa.RecordBatch]:
        upto = np.cumsum(reader.counts)
        sums = np.zeros(len(upto), np.int64)
        text, at, crc = 0, 0, 0
        for ids in reader.ids():
            data, stop = memoryview(ids.astype("<u4").tobytes()), at + len(ids)
            begin = at
            while text < len(upto) and upto[text] <= stop:
                end = int(upto[text])
                sums[text] = zlib.crc32(data[4 * (at - begin) : 4 * (end - begin)], crc)
                text, at, crc = text + 1, end, 0
            crc, at = zlib.crc32(data[4 * (at - begin) :], crc), stop
        columns = [pa.array(reader.keys, pa.int64(), mask=reader.no_key),
                   *(pa.array(v, pa.int64()) for v in (start + upto - reader.counts, reader.counts, sums))]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _CHECKED.split(", ")])

    return _read(spark, root, _CHECKED, of)


def token_ids(spark: SparkSession, root: str) -> DataFrame:
    """Per text: key, start and the array of its ids, the end id included."""

    def of(reader: _Reader, start: int) -> Iterator[pa.RecordBatch]:
        upto = np.cumsum(reader.counts)
        firsts = start + upto - reader.counts
        held, n_held, text = [], 0, 0
        for ids in reader.ids():
            held.append(ids.astype(np.int64))
            n_held += len(ids)
            ready = int(np.searchsorted(np.cumsum(reader.counts[text:]), n_held, "right"))
            if not ready:
                continue
            own, data = slice(text, text + ready), np.concatenate(held)
            edges = np.concatenate([[0], np.cumsum(reader.counts[own])])
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(data[: edges[-1]]))
            keys = pa.array(reader.keys[own], pa.int64(), mask=reader.no_key[own])
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(firsts[own], pa.int64()), lists], names=["key", "start", "ids"]
            )
            held, n_held, text = [data[edges[-1] :]], n_held - int(edges[-1]), text + ready

    return _read(spark, root, _WHOLE, of)


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the binary files and back."""
    import public_tokenizers

    root = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), "text", "doc_id", root, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(spark, root).withColumnRenamed("key", "doc_id")
