from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tradewind.llm import decontam

ITEMS = "item_id long, text string"


def words(draw, n):
    return ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def smith_waterman(item, text):
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            step = decontam.MATCH if a == b else decontam.OTHER
            h[i + 1][j + 1] = max(0, h[i][j] + step, h[i][j + 1] - 1, h[i + 1][j] - 1)
            best = max(best, h[i + 1][j + 1])
    return best


def test_alignment_equals_the_plain_recurrence():
    draw = np.random.default_rng(1)
    items = draw.integers(10, 14, (40, 9)).astype(np.uint64)
    texts = draw.integers(10, 14, (40, 30)).astype(np.uint64)
    lengths = draw.integers(1, 10, 40)
    score, _ = decontam.align(items, lengths, texts)
    for i in range(40):
        assert score[i] == smith_waterman(items[i, : lengths[i]].tolist(), texts[i].tolist())


def brute(texts, items, least):
    """All documents against all items, without seeds; short items whole."""
    found = {}
    for d, text in texts.items():
        for i, item in items.items():
            a, b = (item or "").lower().split(), (text or "").lower().split()
            due = least if len(a) >= decontam.SHORT else 1
            if a and smith_waterman(a, b) >= due * decontam.MATCH * len(a):
                found[d, i] = smith_waterman(a, b) / (decontam.MATCH * len(a))
    return found


def test_exact_edited_and_clean_documents(spark, documents):
    draw = random.Random(2)
    items = {i: " ".join(words(draw, 30)) for i in range(6)} | {6: "two words", 7: None, 8: ""}
    texts = {i: " ".join(words(draw, 120)) for i in range(30)}
    filler = lambda n: words(draw, n)
    for i in range(6):
        item = items[i].split()
        texts[100 + i] = " ".join([*filler(50), *item, *filler(20)])
        edited = [w if draw.random() > 0.12 else draw.choice(words(draw, 1)) for w in item]
        texts[200 + i] = " ".join([*filler(10), *edited, *filler(50)]).upper()
        texts[300 + i] = " ".join([*item[:6], *filler(80)])
    texts |= {400: None, 401: "", 402: " ".join(item * 300), 403: "x two words y", 404: "two x words"}
    # One item in very many documents.
    texts |= {500 + i: " ".join([*filler(5), items[0], *filler(5)]) for i in range(120)}
    folder = documents(list(texts.items()), benchmark=(ITEMS, list(items.items())))
    rows = decontam.op5_decontamination(spark, folder).collect()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    assert len(rows) == len(got)
    want = brute({d: t for d, t in texts.items() if d != 402}, items, 0.5)
    assert {k: v for k, v in got.items() if k[0] != 402} == want
    assert (403, 6) in got and (404, 6) not in got
    assert {(100 + i, i) for i in range(6)} <= set(got) and (402, 5) in got
    assert not any(d < 100 or 300 <= d < 400 for d, _ in got)


def edited(draw, item, kind):
    """Copies that keep no three words in a row, and random ones."""
    if kind == 0:
        return [w if k % 3 else words(draw, 1)[0] for k, w in enumerate(item)]
    if kind == 1:
        return [x for w in item for x in (w, words(draw, 1)[0])]
    if kind == 2:
        return [x for k, w in enumerate(item) for x in ([w, words(draw, 1)[0]] if k % 2 else [w])]
    if kind == 3:
        return [w for k, w in enumerate(item) if k % 3 or draw.random() < 0.3]
    change = draw.random() * 0.6
    out = []
    for w in item:
        what = draw.random()
        out += [] if what < change / 3 else words(draw, 1) if what < 2 * change / 3 else [w]
        out += words(draw, 1) if draw.random() < change / 3 else []
    return out


def test_no_edit_that_aligns_is_lost(spark, documents):
    draw = random.Random(12)
    stops = ["the", "of", "and", "in"]
    items = {}
    for i, n in enumerate([5, 6, 7, 8, 11, 14, 20, 30, 45, 60]):
        items[i] = " ".join(draw.choice(stops) if draw.random() < 0.4 else w for w in words(draw, n))
    texts = {}
    for d in range(400):
        own = [draw.choice(stops) if draw.random() < 0.4 else w for w in words(draw, 70)]
        copy = edited(draw, items[d % 10].split(), d // 10 % 8)
        texts[d] = " ".join([*own[: d % 50], *copy, *own[d % 50 :]])
    folder = documents(list(texts.items()), benchmark=(ITEMS, list(items.items())))
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    for least in (0.5, 0.35, 0.8):
        found = decontam.find_leaks(docs, "text", ["doc_id"], bench, least=least).collect()
        got = {(r["doc_id"], r["item_id"]): r["score"] for r in found}
        want = brute(texts, items, least)
        assert got == want
        kept = decontam.without_leaks(docs, "text", bench, least=least).select("doc_id").collect()
        assert {r["doc_id"] for r in kept} == set(texts) - {d for d, _ in want}
    # Every third word changed: found although no three words are left in a row.
    item = words(draw, 30)
    part = decontam.Slice(pa.array([" ".join(edited(draw, item, 0) + words(draw, 40))]))
    held = decontam.Items([1], [" ".join(item)])
    assert decontam.leaks_of(part, held, 0.5) == []
    held.choose_words(np.zeros(len(held.known), int), held.least(0.5, decontam.SHORT))
    assert [x[2] >= 0.5 for x in decontam.leaks_of(part, held, 0.5)] == [True]


def test_short_items_are_reported_whole_and_drop_nothing(spark, documents):
    items = [(1, "the"), (2, "two words"), (3, "two words")]
    folder = documents(["in the house", "Two WORDS", "two x words", None], benchmark=(ITEMS, items))
    rows = decontam.op5_decontamination(spark, folder).select("doc_id", "item_id", "score").collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1, 1.0), (1, 2, 1.0), (1, 3, 1.0)]
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert decontam.without_leaks(docs, "text", bench).count() == 4


def test_blocks_give_what_one_block_gives(spark, documents):
    draw = random.Random(5)
    items = [(i, " ".join(words(draw, 12))) for i in range(9)]
    texts = [f"{items[i % 9][1]} {' '.join(words(draw, 9))}" for i in range(20)] + ["clean words only"]
    folder = documents(texts, benchmark=(ITEMS, items + items[:1]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    run = lambda block: sorted(
        map(tuple, decontam.find_leaks(docs, "text", ["doc_id", "n_chars"], bench, block=block).collect())
    )
    assert run(3) == run(1000) and len(run(3)) == 20 + 3


def test_edited_copies_with_few_seeds_left_in_many_documents(spark, documents):
    draw = random.Random(8)
    item = words(draw, 20)
    texts = {}
    for i in range(300):
        # Six of 18 seeds stay: 2 * 16 - 4 of 40.
        edited = [draw.choice(words(draw, 1)) if k in (3, 7, 11, 15) else w for k, w in enumerate(item)]
        texts[i] = " ".join([*words(draw, 30), *edited, *words(draw, 30)])
        texts[1000 + i] = " ".join([*words(draw, 30), *item[:3], *words(draw, 30)])
    folder = documents(list(texts.items()), benchmark=(ITEMS, [(1, " ".join(item))]))
    got = {r["doc_id"]: r["score"] for r in decontam.op5_decontamination(spark, folder).collect()}
    assert got == {i: 0.7 for i in range(300)}
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert {r["doc_id"] for r in decontam.without_leaks(docs, "text", items).collect()} == set(range(1000, 1300))


def test_bound_refuses_no_pair_that_reaches_the_score():
    draw = random.Random(9)
    for n, least in [(6, 0.5), (9, 0.3), (12, 0.8)] * 60:
        item = [draw.randrange(10, 22) for _ in range(n)]
        text = [draw.randrange(10, 40) if draw.random() < 0.4 else draw.choice(item) for _ in range(30)]
        reaches = smith_waterman(item, text) >= least * decontam.MATCH * n
        assert decontam._may_reach(np.array(text), np.array(item), least) or not reaches


def test_empty_tables(spark, documents):
    folder = documents(["a b c d"], benchmark=(ITEMS, []))
    assert decontam.op5_decontamination(spark, folder).count() == 0
    folder = documents([], benchmark=(ITEMS, [(1, "a b c")]))
    assert decontam.op5_decontamination(spark, folder).count() == 0
    assert decontam.leaks_of(decontam.Slice(pa.array(["", None])), decontam.Items([], []), 0.5) == []
