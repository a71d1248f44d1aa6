from __future__ import annotations

import glob
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewind.llm import simple8b, tokenids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1), st.just(0)), max_size=400),
    st.integers(1, 300),
)
def test_numbers_come_back(values, block):
    values = np.array(values, np.uint64)
    words, n_words, escapes, n_escapes = simple8b.encode(values, block)
    sizes = np.full(len(n_words), block)
    if len(sizes):
        sizes[-1] = len(values) - (len(sizes) - 1) * block
    assert (simple8b.decode(words, n_words, escapes, n_escapes, sizes) == values).all()
    assert len(escapes) == (values >= 1 << 60).sum()


def test_words_take_as_many_numbers_as_fit():
    words, n_words, _, _ = simple8b.encode(np.array([0] * 240 + [1] * 60 + [7] * 20 + [40_000] * 3, np.uint64), 1000)
    assert n_words.tolist() == [4]
    assert (words >> np.uint64(60)).tolist() == [0, 2, 4, 13]
    assert all(c * b <= 60 for c, b in simple8b.SELECTORS)


PARTS = ["the", " The", "  ", "\n", "\n\n", "\t", "'s", "n't", "I'LL", "42", " 7", "é", " ß", "日本", "\u00a0", "\u2003",
         "\x85", "\x1c", "\x00", "!", "...", " ...", "<|endoftext|>", "😀", "a\u0301", "\r\n", "_", "word", " x"]


def test_pieces_encode_like_whole_texts(plain):
    draw = random.Random(3)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(60))) for _ in range(1500)]
    texts += [None, "", " ", "\n", "a", " a", "a ", "<|endoftext|>"]
    encoder = tokenids.Encoder(PATH)
    assert encoder.by_pieces
    ids, counts = encoder.encode(pa.array(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == plain(t), repr(t)


def test_equal_hashes_are_told_apart(plain, monkeypatch):
    class Poor:
        def __init__(self, raw):
            pass

        def hashes(self, starts, ends):
            return (ends - starts) % 3

    monkeypatch.setattr(tokenids.tg, "Ranges", Poor)
    texts = ["one two three four five", "six seven two two", " one"]
    ids, counts = tokenids.Encoder(PATH).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in plain(t)]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokenids.Encoder(path)
    assert not encoder.by_pieces
    want = Tokenizer.from_file(path)
    ids, counts = encoder.encode(pa.array(["Some Words here", None]))
    assert ids.tolist() == want.encode("Some Words here", add_special_tokens=False).ids
    assert counts.tolist() == [len(ids), 0]


def brute(data, plain):
    """Rows by ascending id; equal ids are compared without `start`."""
    out, start = [], 0
    for i, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain(t), 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, documents, plain, monkeypatch):
    monkeypatch.setattr(tokenids, "BLOCK_IDS", 64)
    draw = random.Random(5)
    data = [(draw.randrange(10**6) * 10 + k % 10, "".join(draw.choice(PARTS) for _ in range(draw.randrange(300))))
            for k in range(300)]
    data += [(-5, None), (-4, ""), (-3, "x " * 30_000), (-(2**62), " "), (None, "no id")]
    rows = tokenids.op12_token_ids(spark, documents(data)).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == brute(data, plain)


def test_repeated_ids_and_rows(spark, documents, plain):
    data = [(1, "a b"), (1, "a b"), (1, "c"), (0, "z"), (2, None)]
    rows = sorted(map(tuple, tokenids.op12_token_ids(spark, documents(data)).collect()), key=lambda r: r[1])
    assert sorted((r[0], *r[2:]) for r in rows) == sorted((r[0], *r[2:]) for r in brute(data, plain))
    assert [r[1] for r in rows] == np.concatenate([[0], np.cumsum([r[2] for r in rows])[:-1]]).tolist()


def test_empty_table(spark, tables):
    folder = tables(documents=("doc_id long, text string", []))
    assert tokenids.op12_token_ids(spark, folder).collect() == []


def test_files_hold_whole_texts(spark, tmp_path, plain, monkeypatch):
    monkeypatch.setattr(tokenids, "BLOCK_IDS", 16)
    monkeypatch.setattr(tokenids, "READ_BLOCKS", 2)
    data = [(k, "some text " * (k % 7), k, "key") for k in range(200)]
    df = spark.createDataFrame(data, "id long, body string, start long, key string").repartition(5)
    root = f"{tmp_path}/ids"
    tokenids.write_ids(df, "body", "id", root, PATH, end=50256)
    rows = tokenids.token_ids(spark, root).orderBy("key").collect()
    assert [r.ids for r in rows] == [[*plain(t), 50256] for _, t, _, _ in data]
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()
    files = tokenids.manifest(spark, root).collect()
    assert sum(f.n_texts for f in files) == 200 and sum(f.n_bytes for f in files) > 0


def test_damaged_files_are_named(spark, tmp_path):
    root = f"{tmp_path}/ids"
    df = spark.createDataFrame([(1, "some text")], "id long, body string")
    tokenids.write_ids(df, "body", "id", root, PATH)
    (path,) = glob.glob(f"{root}/*.tws8")
    data = bytearray(open(path, "rb").read())
    data[len(tokenids.MAGIC) + 20] ^= 1
    with open(path, "wb") as file:
        file.write(data)
    with pytest.raises(Exception, match=os.path.basename(path)):
        tokenids.checksums(spark, root).collect()
