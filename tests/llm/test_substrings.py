from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tradewind.llm import substrings


def brute(texts, length):
    whole = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in whole for i in range(len(b) - length + 1))
    out = []
    for b in whole:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def sample(seed):
    draw = random.Random(seed)
    text = lambda n: "".join(draw.choice("abc dé\n") for _ in range(n))
    texts = [text(draw.randrange(900)) for _ in range(50)]
    shared = [text(n) for n in (150, 199, 200, 201, 260, 700)]
    for s in shared:
        for _ in range(4):
            texts.append(text(draw.randrange(300)) + s + text(draw.randrange(300)))
    base = text(1500)
    for _ in range(12):
        copy = list(base)
        for _ in range(draw.randrange(5)):
            copy[draw.randrange(len(copy))] = "#"
        texts.append("".join(copy))
    texts += [None, "", "a" * 150, "a" * 700, "ab" * 400, shared[5] * 3, texts[0], texts[0]]
    texts += [text(200), text(199)] + ["é" * 300] * 2
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, documents, monkeypatch, seed):
    # Small chunks and buckets, so that several of each take part.
    monkeypatch.setattr(substrings.pk, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(substrings.pk.pack, "__defaults__", (4000,))
    texts = sample(seed)
    rows = substrings.op2_substring_dedup(spark, documents(texts)).collect()
    want = brute(texts, 200)
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        assert got == want[r["doc_id"]], (r["doc_id"], texts[r["doc_id"]])


def test_repeated_rows_null_ids_and_empty_tables(spark, documents):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(250))
    rows = substrings.op2_substring_dedup(spark, documents([(None, text), (3, text), (3, "x")]))
    got = sorted((r["doc_id"] or 0, r["n_removed"], r["n_spans"]) for r in rows.collect())
    assert got == [(0, 250, 1), (3, 0, 0), (3, 250, 1)]
    assert substrings.op2_substring_dedup(spark, documents([])).count() == 0


def test_other_columns_and_the_kept_bytes(spark):
    docs = spark.createDataFrame([(1, "q" * 300, "a"), (2, "yes", None)], "chunk int, t string, bucket string")
    rows = substrings.remove_repeats(docs, "t", ["chunk", "bucket"], with_text=True).collect()
    assert sorted((r["chunk"], r["bucket"], bytes(r["kept"])) for r in rows) == [(1, "a", b""), (2, None, b"yes")]


def test_packed_texts_take_less_room_than_at_the_lowest_level():
    from tradewind.llm import packed as pk

    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(2000)]
    lines = [rng.choices(words, k=12) for _ in range(400)]
    text = " ".join(" ".join(rng.choice(lines)[: rng.randint(2, 9)]) for _ in range(20_000)).encode()
    small = pk.squeeze(text, substrings.BLOB_LEVEL)
    assert len(small) < 0.95 * len(pk.squeeze(text))
    assert pk.unsqueeze(small).tobytes() == text
