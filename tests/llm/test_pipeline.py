from __future__ import annotations

import base64
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tradewind.llm import secrets

from .test_decontam import ITEMS, smith_waterman
from .test_jaccard import brute as components
from .test_secrets import brute as findings

EN = "the and of ring with that this from shall thing word line paper house river stone".split()
DE = "der und für über schön nicht eine straße auch haus fluß stein wörter zeile".split()


def corpus():
    draw = random.Random(11)
    texts, langs = [], []

    def add(text, lang):
        texts.append(text)
        langs.append(lang)

    def body(words, n=60):
        return [draw.choice(words) + draw.choice(words) for _ in range(n)]

    items = [" ".join(body(EN, 25)) for _ in range(3)]
    for i in range(70):
        lang, words = (("en", EN), ("de", DE))[i % 2]
        text = body(words)
        add(" ".join(text), lang)
        if i % 9 == 0:
            text[5] = draw.choice(words)
            add(" ".join(text), lang)
            add(" ".join(text), lang)
    for item in items:
        add(" ".join(body(EN, 20) + item.split() + body(EN, 20)), "en")
        add(" ".join(body(EN, 20) + ["changed" if k == 7 else w for k, w in enumerate(item.split())]), "en")
    for i in range(4):
        add(" ".join(body(EN)) + f' token = "0123456789abcdef012345678{i}"', "en")
    texts += [None, "", "12 34 !!"]
    langs += ["en"] * 3
    rows = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    return rows, [(i, t) for i, t in enumerate(items)]


def expected(rows, items):
    """Ids and texts that reach the mixing stage."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    root = {d: c for d, _, c in components([(r[0], r[1]) for r in rows], 5, 80)}
    rows = [r for r in rows if root[r[0]] == r[0]]
    leaks = lambda text: any(
        smith_waterman(i.split(), text.lower().split()) >= len(i.split()) for _, i in items
    )
    return {r[0]: r[1] for r in rows if not leaks(r[1])}


def test_stages_take_effect_and_keep_clean_documents(spark, documents):
    rows, items = corpus()
    folder = documents(rows, benchmark=(ITEMS, items))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = expected(rows, items)
    assert len(rows) - len(want) > 20
    names, schema = [n for n, _ in pipeline.STAGES], docs.schema
    assert names == ["language", "near_copies", "decontamination", "secrets", "mixing"]
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.stored(stage(spark, docs, folder), name)
        assert docs.schema == schema
    left = {r["doc_id"]: r for r in docs.collect()}
    assert set(left) == set(want)
    for i, text in want.items():
        assert findings(left[i]["text"])[3] == ""
        if not findings(text)[3]:
            assert left[i]["text"] == text
        assert left[i]["n_chars"] == len(left[i]["text"])
    mixed = pipeline.mix_sources(spark, docs, folder)
    assert mixed.columns[: len(schema)] == schema.fieldNames()
    counts = Counter(r["source"] for r in mixed.collect())
    assert set(counts) == {"s0", "s1", "s2"}


def test_language_stage_rejects_noise_and_unknown_scripts_but_no_short_text(spark, documents):
    draw = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda chars: "".join(draw.choice(chars) for _ in range(draw.randint(3, 9)))
    body = lambda words, n: " ".join(draw.choice(words) + draw.choice(words) for _ in range(n))
    clean = [(i, body(EN if i % 2 else DE, 5 + i % 60), "en" if i % 2 else "de", "s", 0) for i in range(600)]
    short = [body(words, n) for words in (EN, DE) for n in (1, 2, 3) for _ in range(5)]
    short += ["the", "für", "paperword key0=4f1e9ac07b3d2286aa5510c9e7d4 ringstone houseriver 12@a.example"]
    cyrillic, cjk = [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x9FFF)]
    noise = [" ".join(word(kind) for _ in range(n)) for kind in (letters, cyrillic, cjk) for n in (12, 60, 900)]
    noise.append(base64.b64encode(draw.randbytes(3000)).decode())
    rows = clean + [(1000 + i, t, "en" if i % 2 else None, "s", 0) for i, t in enumerate(short)]
    # Some of the noise is labelled as a language.
    rows += [(2000 + i, t, "en" if i % 2 else None, "s", 0) for i, t in enumerate(noise)]
    folder = documents(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r["doc_id"] for r in pipeline.language(spark, docs, folder).select("doc_id").collect()}
    assert left == {r[0] for r in rows if r[0] < 2000}


def test_run_equals_its_stages_and_takes_clashing_columns(spark, documents):
    rows, items = corpus()
    folder = documents(rows, benchmark=(ITEMS, items))
    out = pipeline.run(spark, folder)
    assert {r["doc_id"] for r in out.collect()} <= set(expected(rows, items))
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
        {k: F.lit(1) for k in ("id", "n", "blob", "t", "k0", "row", "tag", "low", "a", "hits")}
    )
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.stored(stage(spark, docs, folder), name)
        assert after.columns == docs.columns
        docs = after
    assert "k0" in pipeline.mix_sources(spark, docs, folder).columns


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_empty_table_and_repeated_or_null_rows(spark, documents, name, stage):
    folder = documents([], benchmark=(ITEMS, []))
    empty = spark.read.parquet(f"{folder}/documents.parquet")
    assert pipeline.stored(stage(spark, empty, folder), name).count() == 0
    odd = spark.createDataFrame(
        [(None, "the house by the river " * 3, None, None, None)] * 2 + [(4, None, "en", "s", 0)] * 2, empty.schema
    )
    assert pipeline.stored(stage(spark, odd, folder), name).count() <= 8


def test_secrets_mark(spark):
    assert secrets.redact(F.lit("x"), F.array().cast(secrets._SPANS)) is not None
