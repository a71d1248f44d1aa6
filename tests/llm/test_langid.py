from __future__ import annotations

import pyarrow as pa
import numpy as np

from tradewind.llm import langid

WORDS = {
    "en": "the and of ring with that this from shall thing",
    "de": "der und für über schön nicht eine straße auch",
    "ru": "это не как что для слово язык мы",
}


def corpus(n=240):
    rows = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        words = WORDS[lang].split()
        text = " ".join(words[(i * 7 + j * (1 + i % 5)) % len(words)] for j in range(3 + i % 40))
        rows.append((i, text, lang, "s", 1))
    return rows


def test_held_out_accuracy_and_edges(spark, documents):
    more = [
        (1001, None, "en", "s", 0),
        (1002, "", "en", "s", 0),
        (1003, "123 ... \n", "de", "s", 0),
        (1004, "und über", None, None, None),
        (None, "this thing", "en", "s", 0),
        (1005, "the " * 100_000, "en", "s", 0),
        (1005, "the " * 100_000, "en", "s", 0),
    ]
    rows = langid.op9_language_id(spark, documents(corpus() + more)).collect()
    assert len(rows) == 247
    got = {r["doc_id"]: r for r in rows}
    assert all(got[i]["lang_pred"] == langs for i, _, langs, _, _ in corpus())
    assert [got[i]["lang_pred"] for i in (1001, 1002, 1003)] == ["und"] * 3
    assert [got[i]["score"] for i in (1001, 1002, 1003)] == [0.0] * 3
    assert got[1004]["lang_pred"] == "de" and got[1005]["lang_pred"] == "en"
    assert got[None]["held_out"] and all(0 <= r["score"] <= 1 for r in rows)
    assert 0 < sum(r["held_out"] for r in rows) < 247


def test_labels_of_held_out_rows_are_never_read(spark, documents):
    rows = corpus()
    out = {r["doc_id"] for r in langid.op9_language_id(spark, documents(rows)).collect() if r["held_out"]}
    wrong = [(i, t, "xx" if i in out else lang, s, n) for i, t, lang, s, n in rows]
    found = langid.op9_language_id(spark, documents(wrong)).collect()
    assert {r["lang_pred"] for r in found} == {"en", "de", "ru"}


def test_without_labels_or_rows(spark, documents):
    found = langid.op9_language_id(spark, documents([(1, "some text", None, "s", 1)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)]
    assert langid.op9_language_id(spark, documents([])).count() == 0


def test_kernel_is_the_share_of_common_grams():
    texts = ["abc", "ABC 12", "xyz", "abd"]
    seen, letters = langid.gram_sets(pa.array(texts))
    assert letters.tolist() == [3, 3, 3, 3]
    # Grams of "abc": a b c ab bc abc; those of "ABC 12" also the gap and two with it.
    assert seen.sum(axis=1).tolist() == [6, 9, 6, 6]
    unit = langid._unit(seen)
    kernel = unit @ unit.T
    assert np.allclose(kernel[0], [1, 6 / np.sqrt(54), 0, 3 / 6], atol=1e-6)


def test_clashing_column_names(spark):
    docs = spark.createDataFrame([(1, "the", "a", 5.0)], "id int, text string, bits string, letters double")
    bits = np.packbits(langid.gram_sets(pa.array(["the", "der"]))[0].astype(bool), axis=1)
    model = langid.KernelRidge(bits, ["en", "de"], 8, 1e-4)
    row = langid.predict(docs, "text", model, "p", "s").first()
    assert (row["bits"], row["letters"], row["p"]) == ("a", 5.0, "en")
