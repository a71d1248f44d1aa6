from __future__ import annotations

import pytest


@pytest.fixture()
def tables(spark, tmp_path):
    """tables(documents=(schema, rows), ...) -> a folder with one Parquet table each."""

    def write(**named):
        for name, (schema, data) in named.items():
            df = spark.createDataFrame(data, schema)
            df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(tables):
    """documents([text or (id, text) or whole row, ...]) -> folder; ids count from 0."""

    def write(texts, **others):
        data = []
        for i, t in enumerate(texts):
            if not isinstance(t, tuple):
                t = (i, t)
            if len(t) == 2:
                t = (*t, "en", "s", len(t[1] or ""))
            data.append(t)
        return tables(documents=(DOCUMENTS, data), **others)

    return write
