from __future__ import annotations

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tradewind.llm import mixing


def corpus(sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, "w " * (1 + (i * 7 + k) % 23), "en", source, 1))
            i += 1
    return rows


def plain(tokens, entropy, repeats, budget):
    """Weights by plain bisection."""
    total = sum(tokens.values())
    p = {s: t / total for s, t in tokens.items() if t}

    def weights(a):
        z = sum(x**a for x in p.values())
        return {s: x**a / z for s, x in p.items()}

    def h(a):
        return -sum(w * math.log(w) for w in weights(a).values())

    def rate(a):
        return max(w * budget / tokens[s] for s, w in weights(a).items())

    def bisect(holds, ok, out):
        if holds(out):
            return out
        for _ in range(60):
            ok, out = ((ok + out) / 2, out) if holds((ok + out) / 2) else (ok, (ok + out) / 2)
        return ok

    high = bisect(lambda a: h(a) >= entropy * math.log(len(p)), 0.0, 1.0)
    low = bisect(lambda a: rate(a) <= repeats, 1.0, 0.0)
    return weights(max(high, low))


@pytest.mark.parametrize("entropy,repeats,share", [(0.95, 4, 1.0), (0.999, 1.5, 0.7), (0.5, 9, 2.3), (1.0, 50, 1.0)])
def test_weights_and_budgets(spark, documents, entropy, repeats, share):
    rows = corpus({"a": 600, "b": 60, "c": 25, None: 40})
    docs = spark.read.parquet(f"{documents(rows)}/documents.parquet")
    tokens, size = defaultdict(int), {}
    for i, text, _, source, _ in rows:
        tokens[source] += len(text.split())
        size[i] = len(text.split())
    total = sum(tokens.values())
    target = mixing.Target(entropy, repeats, int(share * total), block_tokens=300)
    taken = mixing.mix(docs, target).collect()
    want = plain(tokens, entropy, repeats, int(share * total))
    got, by_source = defaultdict(int), {}
    for r in taken:
        got[r["source"]] += size[r["doc_id"]]
        by_source[r["source"]] = r["mix_weight"]
    for source, weight in want.items():
        assert by_source[source] == pytest.approx(weight, rel=1e-6)
        # The budget is kept, short of it by less than one document.
        goal = weight * int(share * total)
        assert goal - 23 <= got[source] <= goal + 1
    # Each document at most once per epoch, and whole epochs but for the last.
    assert len({(r["doc_id"], r["mix_epoch"]) for r in taken}) == len(taken)
    for source in want:
        own = [r for r in taken if r["source"] == source]
        last = max(r["mix_epoch"] for r in own)
        per_epoch = defaultdict(set)
        for r in own:
            per_epoch[r["mix_epoch"]].add(r["doc_id"])
        n = sum(1 for x in rows if x[3] == source)
        assert all(len(per_epoch[e]) == n for e in range(last))


def test_last_epoch_is_a_prefix_of_its_permutation(spark, documents):
    docs = spark.read.parquet(f"{documents(corpus({'a': 400}))}/documents.parquet")
    half = mixing.mix(docs, mixing.Target(budget=2000, block_tokens=200)).collect()
    whole = mixing.mix(docs, mixing.Target(budget=10**9, repeats=1, block_tokens=200)).collect()
    order = lambda rows: [r["doc_id"] for r in sorted(rows, key=lambda r: (r["mix_epoch"], r["mix_order"], r["mix_place"]))]
    assert len(whole) == 400 and order(half) == order(whole)[: len(half)]
    again = mixing.mix(docs.repartition(7), mixing.Target(budget=2000, block_tokens=200)).collect()
    assert order(again) == order(half)


def test_nulls_clashing_columns_and_empty_tables(spark, documents):
    rows = [(1, None, "en", "a", 0), (None, "x y", None, None, None), (2, "", "en", "b", 0)] * 2
    folder = documents(rows)
    got = mixing.op4_source_mixing(spark, folder).collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(None, None)}
    docs = spark.createDataFrame([(1, "a b", "s", 5)], "doc_id int, text string, source string, block int")
    assert mixing.mix(docs.withColumn("key", F.lit(3))).first()["block"] == 5
    assert mixing.op4_source_mixing(spark, documents([])).count() == 0
