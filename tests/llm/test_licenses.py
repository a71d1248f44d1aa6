from __future__ import annotations

import re

import duckdb

from tradewind.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans(licenses.UPPER, licenses.LOWER)
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
           "mit license": "mit"}

TEXTS = [
    None,
    "",
    "...",
    "Released under the MIT License. MIT-License, mit license",
    "GNU General Public License; gnu general public, License",
    "gnu general public public license",
    "CC BY 4.0 and CC-BY and ccby; Apache\nLicenseé apache license",
    "Permission is hereby granted, free of charge, to any person obtaining a new copy of this "
    "software and its associated documentation files (the \"Software\"), to deal in the Software",
    "permission is hereby granted free of charge",
    "mit license " * 5000,
    "İstanbul CC BY cc by",
]


def brute(text):
    words = WORD.findall((text or "").translate(UP))
    places = sorted(
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    starts = [p[0] for p in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({p[1] for p in places})))


def test_equals_the_base_rules_and_the_sql(spark, documents):
    folder = documents(TEXTS + TEXTS[:4])
    rows = licenses.op8_license_scan(spark, folder).collect()
    texts = TEXTS + TEXTS[:4]
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == brute(texts[r["doc_id"]])
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["labels"] == "mit" and 0.6 <= by_id[7]["score"] < 1
    assert by_id[8]["labels"] == "" and 0 < by_id[8]["score"] < 0.6
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    want = con.execute(f"select {', '.join(names)} from ({licenses.SQL['op8_license_scan']})")
    assert sorted(want.fetchall(), key=str) == sorted((tuple(r[n] for n in names) for r in rows), key=str)


def test_repeated_rows_and_an_empty_table(spark, documents):
    rows = licenses.op8_license_scan(spark, documents([(5, "cc by"), (5, "cc by"), (None, "x")]))
    assert sorted((r["doc_id"] or 0, r["n_base"]) for r in rows.collect()) == [(0, 0), (5, 1), (5, 1)]
    assert licenses.op8_license_scan(spark, documents([])).count() == 0


def test_columns_named_like_those_inside(spark):
    docs = spark.createDataFrame([(1, "mit license", 7)], "row int, words string, at int")
    found = licenses.scan_licenses(docs, "words", ["row", "at"]).collect()
    assert [(r["row"], r["at"], r["n_base"]) for r in found] == [(1, 7, 1)]
