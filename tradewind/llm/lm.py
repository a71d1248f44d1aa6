"""Language-model scores: a log-bilinear neural model, trained with noise-contrastive estimation.

Counts first: how often each token stands in the training texts, exactly, over all of them.  Of N
training tokens, those found at least sqrt(N) / 16 times form the model's vocabulary, so it grows
with the corpus and holds 16 sqrt(N) tokens at most; all others share one class, within which a
token has its add-one probability.  The model sees the two tokens before: the sum of their
vectors, weighted per position, is multiplied by the vectors of groups of tokens, and then by the
vectors of the tokens of one group.  Both levels are trained in numpy against noise, drawn from
the counted shares of the groups and of the tokens within the group.

Training is dealt by the data alone: a hash of a text and its id names the round and the shard,
whose number follows from N.  Every training text is trained on once (rows equal in text and id
count as one text there); the shards of a round start from the same weights, and a row of weights
becomes the mean of what the shards made of it, weighted by how often they changed it.  So scores
do not depend on how the table is partitioned.

Scores are normalised by batched matrix products, for the contexts that occur in a chunk: over all
groups, and over the tokens of the group that follows.

Defined results: a null or empty text is its end token alone; a null id counts as an empty one;
repeated rows get equal results; without training texts every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed as pk
from . import textgrid as tg
from .common import fold_of, stored, table

END = np.uint64(0xE4D0E4D0E4D0E4D1)
# A token of the vocabulary stands at least sqrt(training tokens) / RARENESS times.
RARENESS = 16
DIMENSIONS = 16
# Noise: groups per batch, tokens of the group per token.
NOISE = 64
NOISE_INSIDE = 4
BATCH = 2048
ROUNDS = 2
STEP = 0.1
# Tokens per shard: so many times the vocabulary, for weights are sent per shard; the upper bound
# is one of memory.
SHARD_SHARE = 256
LEAST_SHARD = 1 << 20
LARGEST_SHARD = 1 << 24
# Rows of weights that one task averages.
BLOCK = 4096
SLICE = 4096


def tokens_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every token, the end of each text included, in order."""
    raw = tg.LOWER[raw]
    starts, ends, docs = tg.words(raw, offsets)
    hashes = tg.Ranges(raw).hashes(starts, ends)
    n = len(offsets) - 1
    # An end goes behind the last word of its text.
    at = np.searchsorted(docs, np.arange(n), "right")
    return np.insert(hashes, at, END), np.insert(docs, at, np.arange(n))


def _count_questions(packed: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, docs = tokens_of(*pk.texts_of(row["offsets"], row["blob"]))
                keys, number = np.unique(hashes, return_inverse=True)
                train = ~np.array(row["k1"], bool)[docs]
                times = np.bincount(number[train], minlength=len(keys)).astype(np.uint32)
                rows = pk.questions(
                    row["chunk"], pk.hash_buckets(keys, buckets), keys,
                    lambda own, times=times: pk.squeeze(times[own]),
                )
                yield pk.question_batch(rows)

    return packed.select("chunk", "offsets", "blob", "k1").mapInArrow(run, pk.QUESTION)


def _sums(keys: list[np.ndarray], extras: list[bytes]):
    """(distinct keys, their sums, number of each entry)."""
    times = np.concatenate([pk.unsqueeze(e, np.uint32) for e in extras])
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(number, times, len(distinct)).astype(np.int64), number


def _answer_counts(keys: list[np.ndarray], extras: list[bytes], chunks: list[int]) -> list[bytes]:
    _, sums, number = _sums(keys, extras)
    return [pk.squeeze(x) for x in np.split(sums[number], np.cumsum([len(k) for k in keys])[:-1])]


def _often_enough(sums: np.ndarray, total: int) -> np.ndarray:
    """Which counts make a token part of the vocabulary of so many tokens."""
    return (sums > 0) & (sums * RARENESS >= isqrt(total))


def _count_summary(keys: list[np.ndarray], extras: list[bytes]) -> bytes:
    """Tokens, distinct tokens, then those frequent enough for the bucket alone, with counts.

    The whole corpus asks for no less than one of its buckets.
    """
    distinct, sums, _ = _sums(keys, extras)
    often = _often_enough(sums, int(sums.sum()))
    head = np.array([sums.sum(), (sums > 0).sum()], np.int64)
    return pk.squeeze(np.concatenate([head, distinct[often].view(np.int64), sums[often]]))


def _log_sum(logits: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1)
    return top + np.log(np.exp(logits - top[:, None]).sum(axis=1))


class Model:
    """Tokens 0..n-1 by falling count; n: any other token; n + 1: before the text (context only).

    Groups are equal stretches of the tokens; the last one holds token n alone.  All weights are
    rows of one matrix: contexts, tokens, groups and the two positions.  The last column is the
    bias of tokens and groups.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        by_count = np.lexsort((words, -counts))
        self.n, self.total, self.distinct = len(words), total, distinct
        self.counts = counts[by_count]
        self.number = np.argsort(words[by_count])
        self.sorted_words = words[by_count][self.number]
        other = total - int(counts.sum())
        self.unit = float(other + distinct - self.n + 1)
        share = np.append(self.counts, other) + 1.0
        self.size = max(1, isqrt(self.n))
        self.groups = -(-self.n // self.size)
        self.begin = np.append(np.minimum(np.arange(self.groups + 1) * self.size, self.n), self.n + 1)
        # Where each token's share of the noise ends.
        self.upto = np.cumsum(share)
        mass = np.diff(np.append(0, self.upto)[self.begin])
        self.group_share = mass / mass.sum()
        self.token_share = share / mass[self.group_of(np.arange(self.n + 1))]
        self.at_token = self.n + 2
        self.at_group = self.at_token + self.n + 1
        self.at_position = self.at_group + self.groups + 1
        draw = np.random.default_rng(7)
        self.rows = draw.normal(0, 0.05, (self.at_position + 2, DIMENSIONS + 1)).astype(np.float32)
        self.rows[: self.at_token, -1] = 0
        self.rows[self.at_position :] = 1
        self.rows[self.at_token : self.at_group, -1] = np.log(self.token_share)
        self.rows[self.at_group : self.at_position, -1] = np.log(self.group_share)

    def group_of(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < self.n, tokens // self.size, self.groups)

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.sorted_words, hashes), self.n - 1)
        return np.where(self.sorted_words[at] == hashes, self.number[at], self.n)

    def kind(self) -> type:
        """How classes are stored."""
        return np.uint16 if self.n < 1 << 16 else np.uint32

    def contexts(self, classes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The classes one and two before each token."""
        out = []
        for back in (1, 2):
            before = np.full(len(classes), self.n + 1)
            same = docs[back:] == docs[:-back]
            before[back:][same] = classes[:-back][same]
            out.append(before)
        return out[0], out[1]

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        # `take` copies whole rows; indexing by an array goes column by column.
        first, second = (self.rows.take(x, axis=0)[:, :-1] for x in (one, two))
        return first * self.rows[self.at_position, :-1] + second * self.rows[self.at_position + 1, :-1]

    def log_probability(self, classes: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised, natural logarithm; of token n it is that of all other tokens together."""
        if not len(classes):
            return np.zeros(0)
        token, group = self.rows[self.at_token : self.at_group], self.rows[self.at_group : self.at_position]
        pairs, context = np.unique(one * (self.n + 2) + two, return_inverse=True)
        h = self.hidden(pairs // (self.n + 2), pairs % (self.n + 2))
        of = self.group_of(classes)
        log_z = np.concatenate(
            [_log_sum(h[k : k + SLICE] @ group[:, :-1].T + group[:, -1]) for k in range(0, len(h), SLICE)]
        )
        score = np.einsum("ij,ij->i", h.take(context, axis=0), group.take(of, axis=0)[:, :-1]) + group[of, -1] - log_z[context]
        # A context and the group that follows it: normalised once, group by group.
        asked, place = np.unique(of * np.int64(len(pairs)) + context, return_inverse=True)
        inside = np.zeros(len(asked), np.float32)
        edges = np.searchsorted(asked, np.arange(self.groups + 1) * np.int64(len(pairs)))
        for g in range(self.groups):
            own = token[self.begin[g] : self.begin[g + 1]]
            for k in range(edges[g], edges[g + 1], SLICE):
                rows = slice(k, min(k + SLICE, edges[g + 1]))
                inside[rows] = _log_sum(h.take(asked[rows] - g * len(pairs), axis=0) @ own[:, :-1].T + own[:, -1])
        known = classes < self.n
        c = classes[known]
        score[known] += np.einsum("ij,ij->i", h.take(context[known], axis=0), token.take(c, axis=0)[:, :-1]) + token[c, -1] - inside[place[known]]
        return score.astype(np.float64)

    def train(self, classes: np.ndarray, one: np.ndarray, two: np.ndarray, seed: int, step: float) -> np.ndarray:
        """One pass over the tokens in random order; how often each row of weights was changed.

        The noise of groups is shared by a batch; the noise inside a group is drawn per token.
        """
        w, draw = self.rows, np.random.default_rng(seed)
        squares, hits = np.full_like(w, 1e-4), np.zeros(len(w), np.int64)
        below = np.append(0, self.upto)
        group_odds = np.log(NOISE * self.group_share).astype(np.float32)
        token_odds = np.log(NOISE_INSIDE * self.token_share).astype(np.float32)
        order = draw.permutation(len(classes))
        place = self.at_position + np.arange(2)
        for begin in range(0, len(order), BATCH):
            pick = order[begin : begin + BATCH]
            c, a, b = classes[pick], one[pick], two[pick]
            h = self.hidden(a, b)
            wide = np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)
            # Groups.
            g = self.group_of(c)
            noise = draw.choice(self.groups + 1, NOISE, p=self.group_share)
            target, wrong = w.take(self.at_group + g, axis=0), w.take(self.at_group + noise, axis=0)
            up = _miss(np.einsum("ij,ij->i", wide, target) - group_odds[g])
            down = -_hit(wide @ wrong.T - group_odds[noise])
            g_h = up[:, None] * target
            g_h += down @ wrong
            ids = [self.at_group + g, self.at_group + noise]
            grads = [up[:, None] * wide, down.T @ wide]
            # Tokens within their groups.
            known = np.flatnonzero(c < self.n)
            if len(known):
                own, wide = c.take(known), wide.take(known, axis=0)
                end = self.begin.take(g.take(known) + 1)
                low, high = below.take(self.begin.take(g.take(known))), below.take(end)
                at = low[:, None] + draw.random((len(own), NOISE_INSIDE)) * (high - low)[:, None]
                # Rounding at an edge must not lead to the next group.
                noise = np.minimum(np.searchsorted(self.upto, at, "right"), end[:, None] - 1)
                target, wrong = w.take(self.at_token + own, axis=0), w.take(self.at_token + noise, axis=0)
                up = _miss(np.einsum("ij,ij->i", wide, target) - token_odds[own])
                down = -_hit(np.einsum("ij,ikj->ik", wide, wrong) - token_odds[noise])
                target *= up[:, None]
                target += np.einsum("ik,ikj->ij", down, wrong)
                g_h[known] += target
                ids += [self.at_token + own, self.at_token + noise.reshape(-1)]
                grads += [up[:, None] * wide, (down[:, :, None] * wide[:, None, :]).reshape(-1, wide.shape[1])]
            g_h[:, -1] = 0
            ids += [a, b, place]
            grads += [g_h * w[place[0]], g_h * w[place[1]], np.stack([(g_h * w.take(x, axis=0)).sum(axis=0) for x in (a, b)])]
            ids, grads = np.concatenate(ids), np.concatenate(grads)
            by_row = _order(ids)
            ids = ids[by_row]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            changed = ids[first]
            slope = np.add.reduceat(grads.take(by_row, axis=0), first, axis=0) / len(pick)
            seen = squares.take(changed, axis=0) + slope * slope
            squares[changed] = seen
            slope *= step
            w[changed] = w.take(changed, axis=0) + slope / np.sqrt(seen)
            hits[changed] += 1
        return hits


def _order(ids: np.ndarray) -> np.ndarray:
    """Stable argsort of row numbers below 2^32, by their halves: numpy sorts 16 bits by radix."""
    order = np.argsort((ids & 0xFFFF).astype(np.uint16), kind="stable")
    if ids.max(initial=0) > 0xFFFF:
        order = order[np.argsort((ids[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _hit(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _miss(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(x, -30, 30)))


def shard_number(total: int, vocabulary: int) -> int:
    """Shards per round for so many training tokens."""
    size = min(LARGEST_SHARD, max(LEAST_SHARD, SHARD_SHARE * vocabulary))
    return max(1, -(-total // (ROUNDS * size)))


def _training_texts(packed: DataFrame, model: Model, shards: int) -> DataFrame:
    """(part, tag, classes) of every training text, stored; part: round * shards + shard."""
    shared = packed.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        kind = known.kind()
        for batch in batches:
            for row in batch.to_pylist():
                hashes, docs = tokens_of(*pk.texts_of(row["offsets"], row["blob"]))
                classes = known.classes(hashes).astype(kind)
                tags = np.array(row["k2"], np.int64)
                edges = np.searchsorted(docs, np.arange(len(tags) + 1))
                first = np.zeros(len(tags), bool)
                first[np.unique(tags, return_index=True)[1]] = True
                pick = np.flatnonzero(first & ~np.array(row["k1"], bool))
                part = tg.mix(tags[pick].view(np.uint64)) % np.uint64(ROUNDS * shards)
                own = [classes[edges[k] : edges[k + 1]].tobytes() for k in pick]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int64)), pa.array(tags[pick]), pa.array(own, pa.binary())],
                    names=["part", "tag", "classes"],
                )

    texts = packed.select("offsets", "blob", "k1", "k2")
    return stored(texts.mapInArrow(run, "part long, tag long, classes binary"), "lm-training")


def _train_round(texts: DataFrame, model: Model, number: int, shards: int) -> None:
    """Train on this round's texts, a shard a task, and merge the weights."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    step = STEP / (1 + number)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = Model.__new__(Model)
        own.__dict__.update(shared.value.__dict__)
        start, own.rows = own.rows, own.rows.copy()
        rows = rows.drop_duplicates("tag").sort_values("tag")
        kind = own.kind()
        each = [np.frombuffer(x, kind) for x in rows["classes"]]
        classes = np.concatenate(each).astype(np.int64)
        one, two = own.contexts(classes, np.repeat(np.arange(len(each)), [len(x) for x in each]))
        part = int(rows["part"].iloc[0])
        hits = own.train(classes, one, two, part, step)
        change = (own.rows - start) * hits[:, None]
        blocks = range(0, len(hits), BLOCK)
        return pd.DataFrame(
            {
                "part": part,
                "block": [k // BLOCK for k in blocks],
                "hits": [pk.squeeze(hits[k : k + BLOCK]) for k in blocks],
                "change": [pk.squeeze(change[k : k + BLOCK].astype(np.float32)) for k in blocks],
            }
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        hits = sum(pk.unsqueeze(x, np.int64) for x in rows["hits"])
        change = sum(pk.unsqueeze(x, np.float32).astype(np.float64) for x in rows["change"])
        mean = change.reshape(len(hits), -1) / np.maximum(1, hits)[:, None]
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "change": [mean.astype(np.float32).tobytes()]})

    own = texts.where((F.col("part") >= number * shards) & (F.col("part") < (number + 1) * shards))
    parts = own.groupBy("part").applyInPandas(run, "part long, block int, hits binary, change binary")
    # The rows together are one model, of a size that the vocabulary bounds.
    for row in parts.groupBy("block").applyInPandas(add, "block int, change binary").toLocalIterator():
        begin = row["block"] * BLOCK
        change = np.frombuffer(row["change"], np.float32).reshape(-1, model.rows.shape[1])
        model.rows[begin : begin + BLOCK] += change


def _model_of(summaries: DataFrame) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                values = pk.unsqueeze(data, np.int64)
                half = (len(values) - 2) // 2
                words = [None, *values[2 : 2 + half].tolist()]
                counts = [values[0].item(), *values[2 + half :].tolist()]
                distinct = [values[1].item(), *[None] * half]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (words, counts, distinct)], names=["word", "n", "distinct"]
                )

    rows = stored(summaries.select("answer").mapInArrow(run, "word long, n long, distinct long"), "lm-counts")
    total, distinct = rows.where("word IS NULL").agg(F.sum("n"), F.sum("distinct")).first()
    # At most RARENESS * sqrt(total) rows.
    often = rows.where(F.col("word").isNotNull() & (F.col("n") * RARENESS >= isqrt(total or 0)))
    often = often.select("word", "n").toArrow()
    words = often.column("word").to_numpy().view(np.uint64)
    return Model(words, often.column("n").to_numpy(), total or 0, distinct or 0)


def train_model(packed: DataFrame, summaries: DataFrame) -> Model:
    """The trained model.  packed: texts with what is kept, whether held out, and a tag."""
    model = _model_of(summaries)
    shards = shard_number(model.total, model.n)
    texts = _training_texts(packed, model, shards)
    for number in range(ROUNDS):
        _train_round(texts, model, number, shards)
    return model


def score_texts(docs: DataFrame, text: str, held_out: Column, keep: list[str]) -> DataFrame:
    """`keep`, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    held_out: which rows the model must not learn from.
    """
    rows = docs.select(
        F.struct(*keep).alias("kept"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
        F.xxhash64(*keep, text).alias("tag"),
        F.col(text).alias("text"),
    )
    packed = pk.pack(rows, "text", ["kept", "held", "tag"])
    buckets = pk.bucket_number(packed.agg(F.sum("bytes")).first()[0] or 0)
    answers = pk.answered(_count_questions(packed, buckets), _answer_counts, _count_summary)
    answers = stored(answers, "lm-answers")
    model = train_model(packed, answers.where("chunk < 0"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(row: pd.Series, said: pd.DataFrame) -> pd.DataFrame:
        known = shared.value
        raw, offsets = pk.texts_of(row["offsets"], row["blob"])
        n = len(offsets) - 1
        hashes, docs = tokens_of(raw, offsets)
        keys, number = np.unique(hashes, return_inverse=True)
        c = np.concatenate([pk.unsqueeze(a, np.int64) for a in said["answer"]])[number]
        base = np.log10((c + 1) / (known.total + known.distinct + 1))
        classes = known.classes(hashes)
        one, two = known.contexts(classes, docs)
        own = known.log_probability(classes, one, two) / np.log(10)
        own += np.where(classes == known.n, np.log10((c + 1) / known.unit), 0)
        return pd.DataFrame(
            {
                "place": np.arange(n),
                "held_out": list(row["k1"]),
                "n_tokens": np.bincount(docs, minlength=n),
                "n_known": np.bincount(docs[c > 0], minlength=n),
                "train_tokens": known.total,
                "base_score": np.bincount(docs, base, n),
                # Rounding of the normalisers must not lift a certain token above 1.
                "score": np.bincount(docs, np.minimum(own, 0), n),
                **{f"k_{i}": pd.Series([x[k] for x in row["k0"]], dtype=object) for i, k in enumerate(keep)},
            }
        )

    kinds = {f"k_{i}": docs.schema[k].dataType.simpleString() for i, k in enumerate(keep)}
    schema = (
        "place long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, " + ", ".join(f"{k} {t}" for k, t in kinds.items())
    )
    found = pk.per_chunk(packed, answers.where("chunk >= 0"), run, schema)
    return found.select(
        *(F.col(f"k_{i}").alias(k) for i, k in enumerate(keep)),
        *"held_out n_tokens n_known train_tokens base_score score".split(),
    )


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learnt from six folds of seven."""
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, "text", fold_of("doc_id", 7) == 2, ["doc_id"])
