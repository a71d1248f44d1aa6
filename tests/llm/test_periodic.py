from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted_words(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute_runs(words, least=6, times=4):
    """Maximal stretches per period; a stretch counts under its smallest period alone."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute(doc_id, text):
    words = planted_words(doc_id, text)
    runs = brute_runs(words)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *best, sha(lines), sha(kept))


def check(rows, data):
    want = sorted((brute(i, t) for i, t in data), key=str)
    assert sorted((tuple(r)[1:] for r in rows), key=str) == want


def texts(seed):
    draw = random.Random(seed)
    out = []
    for size in (2, 3, 26):
        for _ in range(60):
            out.append([draw.choice("abcdefghijklmnopqrstuvwxyz"[:size]) for _ in range(draw.randrange(60))])
    for _ in range(80):
        words = [draw.choice("abcdefgh") for _ in range(draw.randrange(40))]
        for _ in range(draw.randrange(1, 4)):
            unit = [draw.choice("abcx") for _ in range(draw.randrange(1, 30))]
            at, n = draw.randrange(len(words) + 1), draw.randrange(1, 8 * len(unit))
            words[at:at] = [unit[k % len(unit)] for k in range(n)]
        out.append(words)
    # Periods inside periods, and words that look alike in every dyadic way.
    inner = ["a"] * 9 + ["b"]
    out += [inner * 7, (["a", "b"] * 5 + ["c"]) * 6 + ["a", "b"], ["a"] * 300]
    morse = ["a"]
    for _ in range(8):
        morse += ["b" if w == "a" else "a" for w in morse]
    return [*out, morse]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_equal_brute_force(seed):
    many = texts(seed)
    symbols, first = [], []
    for k, words in enumerate(many):
        first.append(len(symbols))
        symbols += [*(ord(w) for w in words), 1000 + k]
    start, length, period = periodic.runs_of(np.array(symbols), max(map(len, many)))
    got = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    want = [(f + s, n, q) for f, w in zip(first, many, strict=True) for s, n, q in brute_runs(w)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_suffix_order_and_range_successor():
    draw = random.Random(4)
    symbols = np.array([draw.randrange(3) for _ in range(200)] + [9])
    order = periodic.Suffixes(symbols, 200).order
    assert order.tolist() == sorted(range(201), key=lambda i: symbols[i:].tolist())
    matrix = periodic.WaveletMatrix(order)
    lo = np.array([draw.randrange(100) for _ in range(50)])
    hi = lo + np.array([draw.randrange(1, 100) for _ in range(50)])
    x = np.array([draw.randrange(201) for _ in range(50)])
    below = matrix.below(lo, hi, x)
    for a, b, v, n in zip(lo, hi, x, below, strict=True):
        part = np.sort(order[a:b])
        assert n == (part < v).sum()
        if n < len(part):
            assert matrix.ranked(*(np.array([z]) for z in (a, b, n)))[0] == part[n]


def test_query_equals_brute_force(spark, documents):
    draw = random.Random(7)
    data = [(i, " ".join(words)) for i, words in enumerate(texts(5))]
    data += [(1000 + i, " \n".join(draw.choice(["é", "ß", "日本", "x"]) for _ in range(200))) for i in range(150)]
    planted = [i for i, _ in data if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 20
    check(periodic.op11_periodic_runs(spark, documents(data)).collect(), data)


def test_edges(spark, documents, tables):
    long_word = "w" * 300_000
    data = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a"), (5, "a a a a a"), (6, "a\ta\na a a a"),
            (7, f"{long_word} " * 6), (8, "x y " * 7), (9, "a b " * 30), (9, "a b " * 30), (None, "a b c d"),
            (None, None), (10, "a \x1c " * 9)]
    check(periodic.op11_periodic_runs(spark, documents(data)).collect(), data)
    empty = periodic.op11_periodic_runs(spark, tables(documents=("doc_id long, text string", [])))
    assert empty.collect() == []


def test_very_long_text(spark, documents):
    unit = " ".join(f"w{i}" for i in range(5000))
    text = f"start {unit} {unit} {unit} {unit} w0 end " + "z " * 40_000
    (row,) = periodic.op11_periodic_runs(spark, documents([(1, text)])).collect()
    assert zlib.crc32(b"1") % 10
    assert (row.n_runs, row.start, row.length, row.period) == (2, 20003, 40000, 1)
    assert row.exponent_milli == 40_000_000
    kept = f"start {unit} end z"
    # The unit repeats once more by its first word; all that follows the first period goes.
    assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_other_columns_keep_names(spark):
    df = spark.createDataFrame(
        [("a a a a a a a b", 1, 2, None)], "text string, start long, runs long, seed long"
    )
    out = periodic.attach_runs(df, "text", "found", "short", seed="seed")
    assert out.columns == ["text", "start", "runs", "seed", "found", "short"]
    row = out.first()
    assert (row.start, row.runs, row.short) == (1, 2, "a b")
    assert [tuple(r) for r in row.found] == [(0, 7, 1)]
    assert periodic.attach_runs(df, "text", "f", "c", least=8).select(F.size("f")).first()[0] == 0


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.runs_of(np.array([1, 1, 2]), 2, times=2)
