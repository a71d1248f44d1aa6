"""Language identification with string kernels.

A text is the set of its character 1- to 3-grams (letters only, lower-case, any run of other
characters one gap), hashed to WIDTH cells: the blended-spectrum presence kernel of two texts is
the number of grams they share, divided by the geometric mean of their set sizes.  A few
training texts serve as Nystroem landmarks; one-versus-rest kernel ridge regression on the
kernel values against them gives a score per language.  Whole texts are scored by two matrix
products per slice of rows.

Scores tell languages apart; they do not tell whether a text is in any of them, since noise is
as unlike one language as another.  For that `Familiarity` takes the mean log share of labelled
documents that hold each gram of the text, and compares it with labelled documents not used for
the shares and with the same texts with their letters shuffled.

Training uses at most `per_language` labelled documents of each language (the documented bound
of the sample), drawn by a hash of the id.

Defined results: a null text or one without a letter is `und` with score 0; so is every text
when nothing is labelled; a null id counts as an empty one; ties go to the language that sorts
first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textgrid as tg
from .common import fold_of, key_text, stored, table, with_fields

UNKNOWN = "und"
WIDTH_BITS = 14
WIDTH = 1 << WIDTH_BITS
# Texts of a slice: each takes WIDTH numbers, however short it is.
MOST_ROWS = 256
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def gram_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(presence matrix of 0 and 1, number of letters) of each text of a slice."""
    raw, offsets = tg.flat(texts)
    n = len(offsets) - 1
    leads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=leads[1:])
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    docs = np.repeat(np.arange(n), np.diff(leads[offsets]))
    codes = _letters()[points]
    letters = np.bincount(docs[codes > 0], minlength=n)
    # One gap for any run of other characters.
    keep = codes > 0
    keep[1:] |= (codes[:-1] > 0) & (docs[1:] == docs[:-1])
    codes, docs = codes[keep].astype(np.uint64) + np.uint64(1), docs[keep]
    seen = np.zeros((n, WIDTH), np.float32)
    cells, row = seen.reshape(-1), docs * WIDTH
    h = codes * _A
    shift = np.uint64(64 - WIDTH_BITS)
    for k in range(3):
        m = max(0, len(codes) - k)
        if k:
            h = (h[:m] ^ (h[:m] >> np.uint64(31))) * _B + codes[k:] * _A
        same = docs[:m] == docs[k:] if k else slice(None)
        cells[(row[:m] + (((h ^ (h >> np.uint64(29))) * _A) >> shift).astype(np.int64))[same]] = 1
    return seen, letters


def _unit(seen: np.ndarray) -> np.ndarray:
    """Rows scaled so that their product is the normalised kernel."""
    return seen / np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))


def _blocks(bits: np.ndarray) -> Iterator[np.ndarray]:
    """Presence rows out of packed ones, a block at a time: a row takes 64 KB, packed two."""
    for i in range(0, len(bits), 64):
        yield np.unpackbits(bits[i : i + 64], axis=1).astype(np.float32)


class KernelRidge:
    """One-versus-rest ridge regression in the space that the landmarks span.

    bits: presence rows of the labelled texts, packed by `np.packbits`.
    """

    def __init__(self, bits: np.ndarray, langs: list[str], landmarks: int, ridge: float):
        self.langs = sorted(set(langs))
        self.familiarity: Familiarity | None = None
        index = np.array([self.langs.index(x) for x in langs])
        # Landmarks from all languages in turn; the rows come in hash order.
        turn = np.zeros(len(langs), np.int64)
        for c in range(len(self.langs)):
            turn[index == c] = np.arange((index == c).sum())
        chosen = np.lexsort((index, turn))[: max(landmarks, len(self.langs))]
        self.points = _unit(np.concatenate(list(_blocks(bits[chosen]))))
        kernel = np.concatenate([_unit(b) @ self.points.T for b in _blocks(bits)]).astype(np.float64)
        goal = np.where(index[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        # Every language weighs the same, however often it is labelled.
        weight = 1 / np.bincount(index)[index][:, None]
        left = kernel.T @ (kernel * weight) + ridge * kernel[chosen]
        self.weights = np.linalg.lstsq(left, kernel.T @ (goal * weight), rcond=None)[0]
        self.weights = self.weights.astype(np.float32)

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return (_unit(seen) @ self.points.T) @ self.weights


# Lengths in letters at which familiarity is calibrated.
SNIPPETS = [8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096]
# Texts of fewer letters say too little to be called foreign.
LEAST_LETTERS = SNIPPETS[0]
LEAST_SNIPPETS = 20
# Words that are keys, numbers or addresses.
_KEY = re.compile(r"[0-9@]")


class Familiarity:
    """Which texts are in none of the languages.

    The cutoff of a length lies three quarters of the way from ordinary labelled texts of that
    length to shuffled ones, and always well below the lowest twentieth of the labelled ones, which
    spares short texts and holds if up to so many labels stand at noise; between lengths it is
    interpolated by the number of grams.  A key or an address does not make a short text foreign
    whose other words are familiar and at least a quarter of it.
    """

    def __init__(self, bits: np.ndarray, langs: list[str], snippets: list[str]):
        index = np.array([sorted(set(langs)).index(x) for x in langs])
        shares = [
            (sum(b.sum(axis=0) for b in _blocks(bits[index == c])) + 0.5) / ((index == c).sum() + 1)
            for c in range(index.max() + 1)
        ]
        self.logs = np.log(np.array(shares, np.float32).T)
        draw = np.random.default_rng(5)
        self.sizes, self.cutoffs = [], []
        for length in SNIPPETS:
            clean = [x[:length] for x in snippets if len(x) >= length]
            if len(clean) < LEAST_SNIPPETS:
                continue
            noise = ["".join(draw.permutation(list(x))) for x in clean]
            known, grams = self._values(clean)
            shuffled, _ = self._values(noise)
            between = 0.25 * np.median(known) + 0.75 * np.median(shuffled)
            self.sizes.append(float(np.log(np.median(grams))))
            low = 2 * np.quantile(known, 0.05) - np.median(known) - 0.3
            self.cutoffs.append(float(min(between, low)))

    def _values(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # A row of grams takes 64 KB: few texts at a time.
        parts = []
        for i in range(0, len(texts), 64):
            seen = gram_sets(pa.array(texts[i : i + 64], pa.string()))[0]
            parts.append((self.value(seen), seen.sum(axis=1)))
        return np.concatenate([v for v, _ in parts]), np.concatenate([n for _, n in parts])

    def value(self, seen: np.ndarray) -> np.ndarray:
        return ((seen @ self.logs) / np.maximum(seen.sum(axis=1, keepdims=True), 1)).max(axis=1)

    def foreign(self, seen: np.ndarray, letters: np.ndarray) -> np.ndarray:
        if not self.sizes:
            return np.zeros(len(letters), bool)
        size = np.log(np.maximum(seen.sum(axis=1), 1))
        return (letters >= LEAST_LETTERS) & (self.value(seen) < np.interp(size, self.sizes, self.cutoffs))

    def foreign_texts(self, texts: pa.Array, seen: np.ndarray, letters: np.ndarray) -> np.ndarray:
        odd = self.foreign(seen, letters)
        again = np.flatnonzero(odd)
        plain = [" ".join(w for w in t.split() if not _KEY.search(w)) for t in texts.take(pa.array(again)).to_pylist()]
        if plain:
            seen, left = gram_sets(pa.array(plain, pa.string()))
            odd[again] = (left < LEAST_LETTERS) | (4 * left < letters[again]) | self.foreign(seen, left)
        return odd


def fit(
    docs: DataFrame,
    text: str,
    lang: str,
    doc_id: str,
    per_language: int = 400,
    landmarks: int = 96,
    ridge: float = 1e-4,
    familiar: bool = False,
) -> KernelRidge | None:
    """Learn from labelled rows; None if there are none.  familiar: also what is in no language."""
    spark = docs.sparkSession
    order = F.xxhash64(key_text(doc_id))
    ids = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), order.alias("place")
    )
    first = Window.partitionBy("lang").orderBy("place", "id")
    ids = ids.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    ids = stored(ids.select("id", "lang", "place").distinct(), "langid-sample")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = rows.join(
        ids, rows["id"].eqNullSafe(ids["id"]) & (rows["lang"] == ids["lang"]), "left_semi"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tg.cut(batch, "text", rows=MOST_ROWS):
                seen, letters = gram_sets(part.column("text"))
                bits = [np.packbits(r.astype(bool)).tobytes() for r in seen]
                heads = [_head(t) if familiar else None for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("lang"), pa.array(bits), pa.array(letters), pa.array(heads, pa.string())],
                    names=["id", "lang", "bits", "letters", "head"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    found = sample.mapInArrow(run, f"id {id_type}, lang string, bits binary, letters long, head string")
    # At most per_language rows of WIDTH / 8 bytes, and as many heads of twice that, for each
    # language (more if ids repeat).
    held = found.where("letters > 0").select(
        "lang", "bits", "head", F.xxhash64(key_text("id")).alias("place")
    )
    held = held.orderBy("place", "bits").collect()
    if not held:
        return None
    bits = np.stack([np.frombuffer(r["bits"], np.uint8) for r in held])
    langs = [r["lang"] for r in held]
    model = KernelRidge(bits, langs, landmarks, ridge)
    if familiar:
        # Equal texts stay on one side: a copy of a known text would be too familiar.
        side = np.array([zlib.crc32(r["bits"]) % 2 for r in held])
        if side.any() and not side.all():
            ours = np.flatnonzero(side)
            model.familiarity = Familiarity(
                bits[ours], [langs[i] for i in ours], [r["head"] for r, s in zip(held, side, strict=True) if not s]
            )
    return model


def _head(text: str) -> str:
    """The first letters of a text, any run of other characters one blank."""
    text = "".join(c if c.isalpha() else " " for c in text[: 4 * SNIPPETS[-1]])
    return " ".join(text.split())[: SNIPPETS[-1]]


def predict(
    docs: DataFrame, text: str, model: KernelRidge | None, pred: str, score: str, foreign: str | None = None
) -> DataFrame:
    """All columns and the predicted language with its score, in one pass without a shuffle.

    foreign: name of a column that says whether the text is in none of the languages.
    """
    schema = with_fields(docs, {pred: "string", score: "double"} | ({foreign: "boolean"} if foreign else {}))
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in tg.cut(batch, place, rows=MOST_ROWS):
                seen, letters = gram_sets(part.column(place))
                if known is None:
                    langs, best = [UNKNOWN] * len(letters), np.zeros(len(letters))
                else:
                    scores = known.scores(seen)
                    top = scores.argmax(axis=1)
                    best = np.clip((scores[np.arange(len(top)), top] + 1) / 2, 0, 1)
                    best = np.where(letters > 0, best, 0).astype(np.float64)
                    langs = [
                        known.langs[t] if there else UNKNOWN
                        for t, there in zip(top, letters > 0, strict=True)
                    ]
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(best)]
                if foreign:
                    judge = known.familiarity if known is not None else None
                    odd = np.zeros(len(letters), bool) if judge is None else judge.foreign_texts(part.column(place), seen, letters)
                    columns.append(pa.array(odd))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    return fold_of(doc_id, 5) == 0


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")), "text", "lang", "doc_id")
    found = predict(docs.select("doc_id", "text"), "text", model, "lang_pred", "score")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
