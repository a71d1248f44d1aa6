"""License scans by diagonal voting.

All rolling word k-grams of every document are joined, by hash, to the positions where license
templates hold the same gram.  A hit votes for the diagonal document position - template
position; votes are summed per diagonal, neighbouring diagonals are merged into bands (words
may be put in or left out), and a band counts if enough of its template stands there.  Hits are
verified word by word in the join, so a hash collision gives no vote.

The template table is broadcast: it is made of the templates handed in, a few thousand grams,
whatever the size of the corpus.  Only hits and one row per document are shuffled.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows each
get their own result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_GRAM, TEMPLATE_GRAM = 2, 5


@dataclass(frozen=True)
class Template:
    """A phrase must stand whole; of a longer template a share of the grams is enough."""

    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.phrase else TEMPLATE_GRAM

    @property
    def n_grams(self) -> int:
        return len(self.words) - self.gram + 1


# The base phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", phrase=True),
    Template("apache", "apache license", phrase=True),
    Template("cc-by", "cc by", phrase=True),
    Template("mit", "mit license", phrase=True),
)
# Opening sentences of public licenses.
NOTICES = (
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + NOTICES


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _template_grams(spark: SparkSession, templates: tuple[Template, ...], phrase: bool) -> DataFrame:
    """(hash, gram, template number, position): every gram of the phrases or of the notices."""
    rows = [
        F.struct(
            F.lit(" ".join(t.words[at : at + t.gram])).alias("t_gram"),
            F.lit(number).alias("template"),
            F.lit(at).alias("t_at"),
        )
        for number, t in enumerate(templates)
        if t.phrase == phrase
        for at in range(t.n_grams)
    ]
    grams = spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.sql(
        "SELECT '' AS t_gram, 0 AS template, 0 AS t_at WHERE false"
    )
    return grams.withColumn("t_hash", F.xxhash64("t_gram"))


def license_hits(
    docs: DataFrame, text: str, keep: list[str], templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """One row per document and gram hit, and one without a hit per document.

    Columns: doc (the columns `keep`), row (a number of the input row), n_words, template,
    at (of the hit in the document), diagonal.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*keep).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        words_of(F.col(text)).alias("words"),
    )
    # The longest gram of each position; the short one is its beginning.
    grams = F.transform(
        "words", lambda w, i: F.concat_ws(" ", F.slice("words", i + 1, TEMPLATE_GRAM))
    )
    rows = rows.select("doc", "row", F.size("words").cast("long").alias("n_words"), grams.alias("g"))
    rows = rows.select("doc", "row", "n_words", F.posexplode_outer("g").alias("at", "gram"))
    rows = rows.withColumn("short", F.substring_index("gram", " ", PHRASE_GRAM))
    for name, phrase, gram in (("p", True, "short"), ("n", False, "gram")):
        known = F.broadcast(_template_grams(spark, templates, phrase)).select(
            *(F.col(c).alias(f"{name}_{c}") for c in ("t_hash", "t_gram", "template", "t_at"))
        )
        same = F.xxhash64(gram) == F.col(f"{name}_t_hash")
        rows = rows.join(known, same & (F.col(gram) == F.col(f"{name}_t_gram")), "left")
    hit = F.col("p_template").isNotNull() | F.col("n_template").isNotNull()
    rows = rows.where(hit | F.col("at").isNull() | (F.col("at") == 0))

    def vote(name: str) -> Column:
        return F.struct(
            F.col(f"{name}_template").alias("template"),
            F.col("at").cast("long").alias("at"),
            F.col(f"{name}_t_at").alias("t_at"),
        )

    # Position 0 stays even without a hit, and stands for its document.
    votes = F.array_distinct(F.array(vote("p"), vote("n")))
    rows = rows.select("doc", "row", "n_words", F.explode(votes).alias("v"))
    return rows.select(
        "doc", "row", "n_words", "v.template", "v.at", "v.t_at",
        (F.col("v.at") - F.col("v.t_at")).alias("diagonal"),
    )


def scan_licenses(
    docs: DataFrame,
    text: str,
    keep: list[str],
    templates: tuple[Template, ...] = TEMPLATES,
    drift: int = 3,
    least: float = 0.6,
) -> DataFrame:
    """Per document: `keep`, n_words, n_base, first_word, last_word, base_labels, labels, score.

    drift: how far diagonals may lie apart and still be one band; least: the share of a
    notice's grams that a band must hold.
    """
    hits = license_hits(docs, text, keep, templates)

    def of_template(value, kind: str) -> Column:
        return F.get(
            F.array(*(F.lit(value(t)).cast(kind) for t in templates)), F.col("template")
        )

    # All that follows is grouped by row first: one exchange serves it all.
    votes = hits.repartition("row").groupBy("row", "template", "diagonal").agg(
        F.first("doc").alias("doc"),
        F.first("n_words").alias("n_words"),
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.collect_set("t_at").alias("t_at"),
    )
    beside = Window.partitionBy("row", "template").orderBy("diagonal")
    away = F.col("diagonal") - F.lag("diagonal").over(beside)
    # Phrases must stand whole, each place on its own diagonal.
    apart = F.when(of_template(lambda t: t.phrase, "boolean") | (away > drift), 1).otherwise(0)
    bands = votes.withColumn("new_band", apart).withColumn("band", F.sum("new_band").over(beside))
    bands = bands.groupBy("row", "template", "band").agg(
        F.first("doc").alias("doc"),
        F.first("n_words").alias("n_words"),
        F.min("diagonal").alias("start"),
        (F.max("last_at") - F.min("first_at")).alias("reach"),
        F.size(F.array_distinct(F.flatten(F.collect_list("t_at")))).alias("held"),
    )
    share = F.col("held") / of_template(lambda t: t.n_grams, "int")
    bands = bands.withColumn("share", F.when(F.col("template").isNotNull(), share))
    phrase = of_template(lambda t: t.phrase, "boolean")
    place = phrase & (F.col("share") == 1.0)
    notice = ~phrase & (F.col("share") >= least)
    label = of_template(lambda t: t.label, "string")

    def listed(labels: Column) -> Column:
        return F.concat_ws(",", F.sort_array(F.collect_set(labels)))

    best = F.max(F.when(place, 1.0).when(~phrase, F.col("share")))
    found = bands.groupBy("row").agg(
        F.first("doc").alias("doc"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("start"))).alias("first_word"),
        F.max(F.when(place, F.col("start"))).alias("last_word"),
        listed(F.when(place, label)).alias("base_labels"),
        listed(F.when(place | notice, label)).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )
    own = "n_words n_base first_word last_word base_labels labels score".split()
    return found.select(*(F.col("doc")[c].alias(c) for c in keep), *own)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def _op8_sql() -> str:
    grams = ", ".join(
        f"({n}, {at}, '{' '.join(t.words[at : at + t.gram])}', {t.gram}, {t.n_grams}, '{t.label}')"
        for n, t in enumerate(TEMPLATES)
        for at in range(t.n_grams)
    )
    return f"""
WITH t(template, t_at, gram, k, n_grams, label) AS (VALUES {grams}),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents),
w AS (
  SELECT row, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
g AS (
  SELECT row, pos, word || ' ' || lead(word, 1) OVER o AS short,
    concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
      lead(word, 4) OVER o) AS gram
  FROM w WINDOW o AS (PARTITION BY row ORDER BY pos)),
v AS (
  SELECT row, template, k, n_grams, label, pos, t_at, pos - t_at AS diagonal
  FROM g JOIN t ON t.gram = CASE WHEN k = {PHRASE_GRAM} THEN g.short ELSE g.gram END),
b AS (
  SELECT *, sum(CASE WHEN k = {PHRASE_GRAM} AND diagonal <> coalesce(before, diagonal - 1)
                       OR diagonal - before > 3 THEN 1 ELSE 0 END)
            OVER (PARTITION BY row, template ORDER BY diagonal, pos) AS band
  FROM (SELECT *, lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal, pos) AS before
        FROM v)),
s AS (
  SELECT row, label, k, min(diagonal) AS start, count(DISTINCT t_at) / any_value(n_grams) AS share
  FROM b GROUP BY row, template, band, label, k),
f AS (
  SELECT row, count(*) FILTER (place) AS n_base, min(start) FILTER (place) AS first_word,
    max(start) FILTER (place) AS last_word,
    list(DISTINCT label ORDER BY label) FILTER (place) AS base_labels,
    list(DISTINCT label ORDER BY label) FILTER (place OR (k > {PHRASE_GRAM} AND share >= 0.6))
      AS labels,
    max(CASE WHEN place THEN 1.0 WHEN k > {PHRASE_GRAM} THEN share END) AS score
  FROM (SELECT *, k = {PHRASE_GRAM} AND share = 1 AS place FROM s) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(labels, ','), '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN f USING (row)
"""


SQL = {"op8_license_scan": _op8_sql()}
