from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

from tradewind.llm import jaccard
from tradewind.llm.components import components
from tradewind.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(UP))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, size=4, share=85):
    sets = [(d, shingles(t, size)) for d, t in docs]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                up[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (d, _) in enumerate(sets):
        low[root(i)] = min(d, low.get(root(i), d))
    return sorted((d, len(a), low[root(i)]) for i, (d, a) in enumerate(sets))


def sample(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcde") for _ in range(4))
    docs = []
    common = [word() for _ in range(25)]
    for size in (3, 5, 8, 9, 10, 11, 12, 14, 18, 25, 40, 90, 200):
        base = [word() for _ in range(size)]
        for _ in range(9):
            text = list(base)
            for _ in range(draw.randrange(0, 3)):
                text[draw.randrange(len(text))] = word()
            docs.append(" ".join(text))
        docs.append(" ".join(base + [word()]))
        docs.append(" ".join(common + base))
    base = [word() for _ in range(120)]
    # A large group around the threshold: copies with changes of their own.
    for _ in range(60):
        text = list(base)
        for _ in range(draw.randrange(0, 4)):
            text[draw.randrange(len(text))] = word()
        docs.append(" ".join(text))
    # Chains of links through lists of two.
    for _ in range(6):
        text = [word() for _ in range(60)]
        for _ in range(5):
            docs.append(" ".join(text))
            text[draw.randrange(len(text))] = word()
    docs += [None, "", " \n", "one", "One", "one two", "a a a a a", "x y z w", "X Y Z W"] * 2
    order = list(range(len(docs)))
    draw.shuffle(order)
    return [(order[i], t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, documents, seed):
    docs = sample(seed)
    rows = jaccard.op10_jaccard_join(spark, documents(docs)).collect()
    assert sorted(map(tuple, rows)) == brute(docs)


def test_both_sides_of_the_boundary_meet(spark, documents, monkeypatch):
    docs = sample(3)
    for boundary in (jaccard.Rule().alone, 9, 12, 60):
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *_, b=boundary: b)
        rows = jaccard.op10_jaccard_join(spark, documents(docs)).collect()
        assert sorted(map(tuple, rows)) == brute(docs), boundary


def test_frequencies_that_fall_together_lose_nothing(spark, documents, monkeypatch):
    docs = sample(4)
    # 256 cells for all tokens, many chunks and buckets.
    monkeypatch.setattr(jaccard, "CELLS", 0)
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(jaccard.pk, "BUCKET_BYTES", 2000)
    rows = jaccard.op10_jaccard_join(spark, documents(docs)).collect()
    assert sorted(map(tuple, rows)) == brute(docs)


def test_other_shingles_and_shares(spark, documents):
    docs = sample(5)
    df = spark.read.parquet(f"{documents(docs)}/documents.parquet")
    rows = jaccard.jaccard_components(df, rule=jaccard.Rule(5, 80)).collect()
    assert sorted(map(tuple, rows)) == brute(docs, 5, 80)


def test_a_hot_group_over_many_partitions(spark, documents):
    draw = random.Random(8)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    docs = []
    for i in range(300):
        text = list(base)
        # Every copy has a word of its own; some are too far away.
        for _ in range(1 if i % 3 else 9):
            text[draw.randrange(150)] = f"x{i}"
        docs.append((i, " ".join(text)))
    docs += [(1000 + i, " ".join(f"y{i}-{k}" for k in range(60))) for i in range(200)]
    df = spark.read.parquet(f"{documents(docs)}/documents.parquet").repartition(40)
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect())) == brute(docs)


def test_only_what_the_result_reads_stays_in_the_scratch_folder(spark, documents):
    df = spark.read.parquet(f"{documents(sample(6))}/documents.parquet")
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(root.iterdir()) if root.exists() else set()
    kept = jaccard.one_of_each(df, "text", "doc_id")
    assert {p.name.rpartition("-")[0] for p in set(root.iterdir()) - before} == {"jaccard-chosen"}
    assert kept.count() == kept.count() > 0


def test_cost_moves_the_boundary():
    sizes = {n: 100 for n in range(6, 200)}
    short, long = jaccard.choose_boundary(sizes, 1.0), jaccard.choose_boundary(sizes, 12.0)
    assert jaccard.Rule().alone <= short < long


def test_repeated_rows_null_ids_and_an_empty_table(spark, documents):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "q r s t u")]
    found = jaccard.op10_jaccard_join(spark, documents(rows)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        ["(None, 2, 7)", "(7, 2, 7)", "(7, 2, 7)", "(None, 2, None)"]
    )
    assert jaccard.op10_jaccard_join(spark, documents([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 0) for i in range(41)} | {
        (i, 100) for i in range(100, 130)
    }
