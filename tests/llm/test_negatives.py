from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import negatives

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def brute(data):
    """The contract row by row, in Python integers."""
    whole = {}
    for i, v, x in data:
        if i is None or v is None or x is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        row = ((x + 1) % 10 if i % 7 == 0 else x, [math.floor(256 * float(np.float32(c))) for c in v])
        whole[i] = min(whole.get(i, row), row)
    out = []
    for a, (label, q) in whole.items():
        if a % 100:
            continue
        score = lambda r: sum(x * y for x, y in zip(q, r[1], strict=False))  # noqa: B023, E731
        order = sorted(((-score(r), i, r[0]) for i, r in whole.items() if i != a))
        for neg, p, _ in [o for o in order if o[2] == label][:5]:
            top = -neg
            fits = [(i, -n) for n, i, x in order if x != label and 80 * top <= -100 * n <= 100 * top]
            out += [(a, p, k, i, top, s) for k, (i, s) in enumerate(fits[:5], 1)]
    return sorted(out)


def sample(seed, n=420, dims=6, labels=4):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    data = []
    for i in range(n):
        centre = draw.choice(centres)
        vector = [c * 0.5 + draw.gauss(0, 0.3) for c in centre]
        if draw.random() < 0.2:
            # Coarse vectors tie often.
            vector = [round(c) / 2 for c in vector]
        data.append((draw.randrange(4 * n) if i % 5 else i * 20, vector, draw.randrange(labels)))
    return list({i: (i, v, x) for i, v, x in data}.values())


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 90)
    monkeypatch.setattr(negatives, "BATCH_ANCHORS", 4)
    monkeypatch.setattr(negatives, "PASS_ANCHORS", 12)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 2)


def run(spark, folder):
    return sorted(map(tuple, negatives.op13_hard_negatives(spark, folder).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_many_blocks_and_passes(spark, tables, small, seed):
    data = sample(seed)
    want = brute(data)
    assert len(want) > 40
    assert run(spark, tables(embeddings=(EMBEDDINGS, data))) == want


def test_equals_sql_and_brute_force(spark, tables):
    data = sample(3)
    folder = tables(embeddings=(EMBEDDINGS, data))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    rows = db.execute(negatives.SQL["op13_hard_negatives"]).fetchall()
    assert sorted(rows) == run(spark, folder) == brute(data)


def test_edges(spark, tables, small):
    nan, inf = float("nan"), float("inf")
    data = sample(4, 200) + [
        (None, [1.0] * 6, 1), (5000, None, 1), (5001, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (5002, [nan] * 6, 1),
        (5100, [inf] * 6, 1), (5101, [1.0] * 6, None), (5200, [], 1), (5201, [0.0] * 6, 1), (5300, [0.0] * 6, 2),
        (5301, [2.0, 2.0], 1), (5302, [2.0, 2.0], 2), (5400, [-3.0] * 6, 3), (5400, [-3.0] * 6, 3), (5400, [-3.0] * 6, 1),
    ]
    assert run(spark, tables(embeddings=(EMBEDDINGS, data))) == brute(data)


def test_hot_vector_and_hot_label(spark, tables, small):
    data = [(i, [0.5, 0.25, -1.0], 1 if i % 3 else 2) for i in range(600)]
    data += [(1000 + i, [0.4, 0.3, -0.9 + i / 1000], 1) for i in range(300)]
    assert run(spark, tables(embeddings=(EMBEDDINGS, data))) == brute(data)


def test_empty_tables_and_no_anchor(spark, tables):
    for data in ([], [(1, [1.0], 1), (2, [1.0], 2)], [(100, None, 1)], [(100, [], 1)]):
        assert run(spark, tables(embeddings=(EMBEDDINGS, data))) == []


def test_large_components_are_scored_exactly(spark):
    data = [(100, [2.0**20, 1.0], 1), (1, [2.0**21, 3.0], 1), (2, [2.0**21, 2.0], 2), (3, [2.0**60, 1.0], 2)]
    df = spark.createDataFrame(data, "i long, v array<double>, score long")
    vectors = negatives.integer_vectors(df, "i", "v", F.col("score"))
    rows = negatives.mine(vectors, F.col("id") == 100).collect()
    scale = 256 * 256
    assert [tuple(r) for r in rows] == [(100, 1, 1, 2, scale * (2**41 + 3), scale * (2**41 + 2))]


def test_lists_are_left_early():
    draw = np.random.default_rng(1)
    vectors = draw.integers(-20, 20, (4000, 8))
    vectors[:40] += 300
    lists = negatives.Lists(np.arange(4000), np.arange(4000) % 2, vectors)
    best = negatives.Best([None], [None], 5)
    anchor = np.full(8, 250)
    scored = negatives.search(lists, -1, 0, anchor, best, True)
    assert scored < 200
    scores = vectors @ anchor
    want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i % 2 == 0)[:5]
    assert list(zip((-best.rows[0][0]).tolist(), best.rows[0][1].tolist(), strict=True)) == want
