from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tradewind.llm import lm
from tradewind.llm import packed as pk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens(text):
    return [*WORD.findall((text or "").translate(UP)), None]


def brute(docs):
    counts = Counter(t for d, text in docs if not held(d) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((d, held(d), len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def chain(n, seed=1):
    """Texts in which a word decides the next one, most of the time."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    follow = {w: draw.choice(words) for w in words}
    docs = []
    for i in range(n):
        word, text = draw.choice(words), []
        for _ in range(60):
            text.append(word)
            word = follow[word] if draw.random() < 0.8 else draw.choice(words)
        docs.append((i, " ".join(text)))
    return docs


def test_counts_and_base_scores(spark, documents, monkeypatch):
    monkeypatch.setattr(pk.pack, "__defaults__", (3000,))
    monkeypatch.setattr(pk, "BUCKET_BYTES", 5000)
    docs = chain(120) + [
        (500, None), (501, ""), (502, "É é W1 w1\x1fx never-seen"), (None, "w2 w3"), (503, "w4 " * 20_000),
        (504, "same text"), (504, "same text"),
    ]
    rows = lm.op6_lm_scores(spark, documents(docs)).collect()
    names = "doc_id held_out n_tokens n_known train_tokens base_score".split()
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    for got, want in zip(sorted((tuple(r[n] for n in names) for r in rows), key=key), sorted(brute(docs), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_model_beats_counts_on_held_out_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 256)
    rows = [r for r in lm.op6_lm_scores(spark, documents(chain(1500))).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.93 * sum(r["base_score"] for r in rows)


def test_model_beats_counts_on_held_out_documents(spark):
    rows = lm.op6_lm_scores(spark, "/root/testdata/sf0.01")
    base, score, n = rows.where("held_out").selectExpr("sum(base_score)", "sum(score)", "sum(n_tokens)").first()
    assert (score - base) / n > 0.04


@pytest.mark.parametrize("shard", [1 << 20, 4000])
def test_scores_do_not_depend_on_partitions(spark, documents, monkeypatch, shard):
    monkeypatch.setattr(pk.pack, "__defaults__", (4000,))
    monkeypatch.setattr(lm, "LEAST_SHARD", shard)
    monkeypatch.setattr(lm, "SHARD_SHARE", 1)
    docs = spark.read.parquet(f"{documents([*chain(400), (900, None), (901, 'w1 w2'), (901, 'w1 w2')])}/documents.parquet")
    found = []
    for n in (1, 16):
        rows = lm.score_texts(docs.repartition(n), "text", lm.fold_of("doc_id", 7) == 2, ["doc_id"])
        found.append(sorted((r["doc_id"], r["score"]) for r in rows.collect()))
    assert [d for d, _ in found[0]] == [d for d, _ in found[1]]
    assert [x for _, x in found[0]] == pytest.approx([x for _, x in found[1]], rel=1e-6)


def prepared(spark, docs):
    """(packed, model before training, all tokens) of texts that may all be learnt."""
    rows = pk.pack(docs.selectExpr("text", "doc_id", "false held", "xxhash64(doc_id, text) tag"), "text", ["doc_id", "held", "tag"])
    tokens = [lm.tokens_of(*pk.texts_of(r["offsets"], r["blob"]))[0] for r in rows.collect()]
    words, counts = np.unique(np.concatenate(tokens), return_counts=True)
    return rows, lm.Model(words, counts, int(counts.sum()), len(words)), int(counts.sum())


def test_one_chunk_is_trained_on(spark, documents):
    one = spark.read.parquet(f"{documents(chain(300))}/documents.parquet").coalesce(1)
    rows, model, _ = prepared(spark, one)
    assert rows.count() == 1
    start = model.rows.copy()
    texts = lm._training_texts(rows, model, 1)
    for number in range(lm.ROUNDS):
        lm._train_round(texts, model, number, 1)
    assert not np.allclose(model.rows, start)


def test_every_text_is_trained_on_in_one_round(spark, documents, monkeypatch):
    monkeypatch.setattr(pk.pack, "__defaults__", (4000,))
    docs = spark.read.parquet(f"{documents([*chain(400), (7000, 'w3 w4'), (7000, 'w3 w4'), (7001, None)])}/documents.parquet")
    rows, model, _ = prepared(spark, docs.coalesce(1))
    texts = lm._training_texts(rows, model, 5).collect()
    assert {r["part"] for r in texts} == set(range(5 * lm.ROUNDS))
    parts = {}
    for r in texts:
        assert parts.setdefault(r["tag"], r["part"]) == r["part"]
    # The repeated row once, the text that is null as its end.
    assert len(parts) == 402
    assert 1 in {len(r["classes"]) // 2 for r in texts}


def test_vocabulary_grows_with_the_tokens():
    # Zipf's law.
    sizes = []
    for total in (10**5, 10**7):
        counts = total / np.arange(1, 10**6) / 14
        sizes.append(int(lm._often_enough(counts.astype(np.int64), total).sum()))
    assert sizes[1] > 5 * sizes[0] > 500
    assert lm.shard_number(0, 0) == 1
    assert lm.shard_number(10**11, 10**6) == -(-(10**11) // (lm.ROUNDS * lm.LARGEST_SHARD))


@pytest.mark.parametrize("n", [0, 1, 12, 40])
def test_probabilities_of_every_context_sum_to_one(n):
    draw = np.random.default_rng(3)
    words = draw.integers(1, 1 << 60, n).astype(np.uint64)
    model = lm.Model(words, draw.integers(1, 50, n), 2900, 60)
    classes = draw.integers(0, n + 1, 3000)
    one, two = model.contexts(classes, np.zeros(3000, int))
    hits = model.train(classes, one, two, 1, 0.1)
    assert (hits[model.at_position :] > 0).all()
    for a in range(n + 2):
        each = np.arange(n + 1)
        logs = model.log_probability(each, np.full(n + 1, a), np.full(n + 1, n + 1 - a))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    # The words are found again, by falling count.
    known = model.classes(words)
    assert sorted(known) == list(range(n)) and (np.diff(model.counts) <= 0).all()
    assert model.classes(np.array([5], np.uint64))[0] == n
    # Within the shared class the unseen tokens have one place together.
    assert model.unit == 2900 - model.counts.sum() + 60 - n + 1


def test_empty_tables(spark, documents):
    assert lm.op6_lm_scores(spark, documents([])).count() == 0
    only_held = [(i, "a b") for i in range(60) if held(i)]
    rows = lm.op6_lm_scores(spark, documents(only_held)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}
    assert all(r["score"] == pytest.approx(0, abs=1e-9) for r in rows)


def test_training_gathers_whole_rows():
    """Rows of weights are copied by `take`; indexing by an array goes column by column."""

    class Watched(np.ndarray):
        gathered = 0

        def __getitem__(self, key):
            Watched.gathered += self is weights and isinstance(key, np.ndarray)
            return super().__getitem__(key)

    weights = None

    def trained(kind):
        nonlocal weights
        model = lm.Model(np.arange(50, dtype=np.uint64), np.arange(50, 0, -1), 1400, 60)
        weights = model.rows = model.rows.view(kind)
        tokens = np.random.default_rng(1).integers(0, 51, 5000)
        one, two = model.contexts(tokens, np.arange(5000) // 40)
        hits = model.train(tokens, one, two, 3, 0.1)
        return hits, np.asarray(model.rows), model.log_probability(tokens, one, two)

    watched, plain = trained(Watched), trained(np.ndarray)
    assert all((a == b).all() for a, b in zip(watched, plain))
    assert Watched.gathered == 0
