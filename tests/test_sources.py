from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.market import NL_TEXT, RAW, write_csv
from tradewind.sources.contracts import CLEAN_TABLES
from tradewind.sources.landing import (
    infer_types,
    load_inferred,
    load_inferred_csv,
    load_staging,
    load_staging_csv,
    normalize_headers,
)
from tradewind.sources.tables import (
    materialize_table,
    LayerVersion,
    StaleVersion,
    expire_versions,
    overwrite_layer,
    publish_bi_tables,
    read_layer,
)


def test_staging_is_text_by_position(spark, tmp_path):
    write_csv(tmp_path)
    raw = load_staging(spark, str(tmp_path))
    for name, (columns, data) in RAW.items():
        assert raw[name].columns == [f.source for f in CLEAN_TABLES[name].fields]
        assert {t for _, t in raw[name].dtypes} == {"string"}
        assert raw[name].count() == len(data), name
    message = raw["order_reviews"].where("trim(review_id) = 'r1'").first().review_comment_message
    assert message == NL_TEXT


def test_unquoted_empty_is_null_and_quoted_empty_is_text(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        "review_id,order_id,review_score,t,m,c,a\n"
        'r1,o1,5,,"","2020-01-01",\n'
        'r2,o2,4," x ","two\nlines ""q""",,\n'
    )
    got = load_staging_csv(spark, "", "order_reviews", str(path)).orderBy("review_id").collect()
    assert (got[0][3], got[0][4], got[0][6]) == (None, "", None)
    assert (got[1][3], got[1][4]) == (" x ", 'two\nlines "q"')


def review_file(path, rows, draw, end="\n", name="r"):
    """Reviews with quotes, commas and line breaks in their messages; the messages by id."""
    quoted = lambda t: '"' + t.replace('"', '""') + '"'
    parts = ["word", "\n", "\r\n", '"', ",", " ", "ß", "\n\n", "r1,o1,5", '""', "\t"]
    want, out = {}, [f"review_id,order_id,review_score,t,m,c,a{end}"]
    for i in range(rows):
        text = "".join(draw.choice(parts) for _ in range(draw.choice([0, 3, 30, 30, 400])))
        want[f"{name}{i}"] = text if text or i % 2 else None
        message = quoted(text) if text or i % 2 else ""
        out.append(f"{name}{i},o{i},{i % 5},,{message},2020-01-01,{end}")
    path.write_bytes("".join(out).encode())
    return want


@pytest.fixture()
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_quotes_cross_the_borders_of_byte_ranges(spark, tmp_path, small_ranges, end):
    draw = random.Random(2)
    want = review_file(tmp_path / "a_reviews.csv", 300, draw, end)
    df = load_staging_csv(spark, "", "order_reviews", str(tmp_path / "a_reviews.csv"))
    rows = df.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) > 10
    assert {r.review_id: r.review_comment_message for r in rows} == want
    assert len(rows) == 300
    assert {(r.review_score, r.review_answer_timestamp) for r in rows} == {(str(i), None) for i in range(5)}


def test_several_files_and_records_longer_than_a_range(spark, tmp_path, small_ranges):
    folder = tmp_path / "reviews"
    folder.mkdir()
    draw = random.Random(3)
    want = {}
    for k in "abc":
        want |= review_file(folder / f"{k}.csv", 20 + ord(k) % 3, draw, name=k)
    long = "line\n" * 5000
    want["x"] = long
    with open(folder / "a.csv", "a", newline="") as file:
        file.write(f'x,o,1,,"{long}",,\n\n')
    rows = load_staging_csv(spark, "", "order_reviews", str(folder)).collect()
    assert {r.review_id: r.review_comment_message for r in rows} == want
    assert len(rows) == len(want)


def test_multi_line_rows_equal_those_of_one_task(spark, tmp_path, small_ranges):
    review_file(tmp_path / "r.csv", 200, random.Random(5))
    contract = CLEAN_TABLES["order_reviews"]
    reader = spark.read.schema(contract.raw_schema()).options(
        header=True, multiLine=True, quote='"', escape='"', emptyValue="", nullValue=None, mode="FAILFAST"
    )
    want = reader.csv(str(tmp_path / "r.csv")).collect()
    got = load_staging_csv(spark, "", "order_reviews", str(tmp_path / "r.csv")).collect()
    key = lambda r: [c or "" for c in r]
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_unmatched_quotes_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('review_id,o,s,t,m,c,a\nr1,o1,5,,"open,,\n')
    with pytest.raises(Exception, match="does not end with its file"):
        load_staging_csv(spark, "", "order_reviews", str(tmp_path / "bad.csv")).collect()
    for name, text in (("none.csv", ""), ("header.csv", "review_id,o,s,t,m,c,a\n")):
        (tmp_path / name).write_text(text)
        assert load_staging_csv(spark, "", "order_reviews", str(tmp_path / name)).collect() == []
    (tmp_path / "short.csv").write_text("review_id,o,s,t,m,c,a\nr1,o1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        load_staging_csv(spark, "", "order_reviews", str(tmp_path / "short.csv")).collect()


def test_short_rows_fail_instead_of_shifting(spark, tmp_path):
    (tmp_path / "s.csv").write_text("seller_id,zip,city,state\ns1,1\n")
    df = load_staging_csv(spark, "", "sellers", str(tmp_path / "s.csv"))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        df.collect()


def test_inference_reads_every_row(spark, tmp_path):
    lines = ["a,b,c"] + [f"{i},{i}.5,2020-01-0{1 + i % 9}" for i in range(3000)] + ["x,1,2020-02-02"]
    (tmp_path / "i.csv").write_text("\n".join(lines))
    got = dict(load_inferred_csv(spark, str(tmp_path / "i.csv")).dtypes)
    assert got == {"a": "string", "b": "double", "c": "date"}


def test_inferred_timestamps_have_no_zone(spark, tmp_path):
    (tmp_path / "t.csv").write_text("t\n2017-10-15 00:00:00\n2017-10-15 00:30:00\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # skips that hour
    try:
        got = load_inferred_csv(spark, str(tmp_path / "t.csv")).selectExpr("cast(t as string)")
        assert [r[0] for r in got.collect()] == ["2017-10-15 00:00:00", "2017-10-15 00:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_inferred_folder_has_ten_tables(spark, tmp_path):
    write_csv(tmp_path)
    got = load_inferred(spark, str(tmp_path))
    assert set(got) == set(CLEAN_TABLES) - {"geolocation"}
    assert dict(got["order_payments"].dtypes)["payment_sequential"] == "int"
    assert got["order_reviews"].count() == len(RAW["order_reviews"][1])


def test_types_are_inferred_from_all_rows_of_all_tables_in_one_job(spark, rows):
    day, time = "2020-01-01", "2020-1-1 7:00:00"
    columns = {
        "int": ["1", "-7", None, "", "007"], "bigint": ["1", "3000000000"], "double": ["1", "3000000000", "2.5", ".5e3"],
        "date": [day, None], "timestamp_ntz": [day, time], "boolean": ["true", "FALSE", ""],
        "string": ["1", day], "string2": ["12345678901234567890"], "string3": ["", None], "string4": ["2020-13-01"],
        "string5": [" 1"], "string6": ["1", "true"],
    }
    data = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(5)]
    table = rows(", ".join(f"{c} string" for c in columns), data).repartition(5)
    spark.sparkContext.setJobGroup("infer", "infer")
    try:
        got = infer_types({"a": table, "b": table.limit(0)})
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("infer")) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got["a"] == {c: c.rstrip("23456") if c.startswith("string") else c for c in columns}
    assert set(got["b"].values()) == {"string"}
    assert infer_types({}) == {}


def test_inferred_tables_keep_values_and_line_breaks(spark, tmp_path):
    write_csv(tmp_path)
    got = load_inferred(spark, str(tmp_path))
    reviews = {r.review_id: r for r in got["order_reviews"].collect()}
    assert reviews["r2"].review_answer_timestamp is None
    assert NL_TEXT in {r.review_comment_message for r in got["order_reviews"].collect()}
    staged = load_staging(spark, str(tmp_path))
    for name, df in got.items():
        assert df.columns == staged[name].columns
        for c, kind in df.dtypes:
            filled = staged[name].where(f"`{c}` <> ''").count()
            assert kind == "string" or df.where(f"`{c}` IS NOT NULL").count() == filled, (name, c)


def test_header_spellings(rows):
    both = rows("product_id string, product_name_length string", [("p", "1")])
    assert normalize_headers(both).columns == ["product_id", "product_name_lenght"]
    fine = rows("product_name_lenght string", [("1",)])
    assert normalize_headers(fine).columns == ["product_name_lenght"]


def test_layer_swap_is_all_or_nothing(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    overwrite_layer(spark, {"a": rows("x int", [(1,)]), "b": rows("y int", [(1,)])}, root)
    broken = rows("x int", [(1,)]).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        overwrite_layer(spark, {"a": rows("x int", [(2,)]), "b": broken}, root)
    assert read_layer(spark, root)["a"].first().x == 1
    overwrite_layer(spark, {"a": rows("x int", [(3,)])}, root)
    now = read_layer(spark, root)
    assert list(now) == ["a"] and now["a"].first().x == 3


def test_materialized_partitions_prune(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("m"))
    stored = materialize_table(df, str(tmp_path / "t"), partition_by=["m"])
    assert stored.columns == ["id", "m"]
    one = stored.where("m = '1'")
    assert one.count() == 333
    assert "PartitionFilters: [isnotnull(m" in one._jdf.queryExecution().toString()


def test_published_tables_are_external(spark, tmp_path, rows):
    df = rows("x int", [(1,), (2,)])
    publish_bi_tables(spark, {"t": df}, str(tmp_path), database="shopbi")
    assert spark.table("shopbi.t").count() == 2
    spark.sql("DROP TABLE shopbi.t")
    assert read_layer(spark, str(tmp_path))["t"].count() == 2
    publish_bi_tables(spark, {"t": df}, str(tmp_path), database="shopbi")
    assert spark.table("shopbi.t").count() == 2


def test_of_two_versions_begun_together_one_is_published(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    overwrite_layer(spark, {"a": rows("x int", [(0,)])}, root)
    first, second = LayerVersion(spark, root), LayerVersion(spark, root)
    for n, version in enumerate((first, second), 1):
        version.put({"a": rows("x int", [(n,)])})
        version.put({"a": rows("x int", [(10 * n,)])}, "bi")
    assert read_layer(spark, root)["a"].first().x == 0
    first.publish()
    with pytest.raises(StaleVersion):
        second.publish()
    assert read_layer(spark, root)["a"].first().x == 1
    assert read_layer(spark, root, "bi")["a"].first().x == 10
    # An entry that is still being written does not count.
    (tmp_path / "layer" / "_versions" / "000000000003.json").write_text("")
    assert read_layer(spark, root)["a"].first().x == 1


def test_old_versions_expire_and_young_folders_stay(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    for n in range(4):
        overwrite_layer(spark, {"a": rows("x int", [(n,)])}, root)
    LayerVersion(spark, root).put({"a": rows("x int", [(9,)])})
    assert expire_versions(spark, root) == []
    assert len(expire_versions(spark, root, keep=2, least_age_hours=0)) == 3
    assert read_layer(spark, root)["a"].first().x == 3


def test_workers_find_the_package_from_any_folder(tmp_path):
    review_file(tmp_path / "r.csv", 20, random.Random(1))
    (tmp_path / "job.py").write_text(
        f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from tradewind.session import open_session
from tradewind.sources.landing import load_staging_csv
spark = open_session("elsewhere", "local[2]", spark__ui__enabled="false")
print("rows", load_staging_csv(spark, "", "order_reviews", {str(tmp_path / "r.csv")!r}).count())
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "job.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200
    )
    assert "rows 20" in done.stdout, done.stderr[-2000:]


def test_stored_tables_are_made_once_and_on_use(spark, tmp_path):
    from tradewind.sources.tables import StoredTables

    made = []

    def plan(name, read=()):
        made.append(name)
        assert all(stored[r].count() == 3 for r in read)
        return spark.range(3)

    stored = StoredTables(
        {"a": lambda: plan("a"), "b": lambda: plan("b", ["a"]), "c": lambda: plan("c")}, str(tmp_path)
    )
    assert list(stored) == ["a", "b", "c"] and len(stored) == 3 and not made
    assert stored["b"].count() == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
    assert stored["a"].count() == 3 and sorted(stored.all()) == ["a", "b", "c"]
    assert sorted(made) == ["a", "b", "c"]


def test_patterns_are_asked_behind_single_characters(spark):
    """The cheap checks in front of the patterns change no type."""
    import re

    from tradewind.sources import landing

    shape = landing._shape_bit("t")
    assert shape.index("substr(t, 1, 1) NOT IN") < shape.index("RLIKE")
    assert shape.count("substr(t, 5, 1) = '-' AND t RLIKE") == 2
    texts = {
        "7": 1, "-7": 1, "+0012": 1, "3000000000": 2, "99999999999999999999": 64, "1.5": 4, ".5": 4,
        "-.5e3": 4, "123e-5": 4, "1234-5": 64, "2018-01-02": 8, "2018-1-2": 8, "2018-13-45": 64,
        "2018-01-02 10:00:00": 16, "2018-1-2T9:05": 16, "2018-01-02 x": 64, "tRuE": 32, "False": 32,
        "truth": 64, "f": 64, "-": 64, "-5-1": 64, "abc": 64, " 7": 64, "\n7": 64, "é": 64, "": 0, None: 0,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.b for r in rows.selectExpr("t", f"{shape} AS b").collect()}
    assert found == texts
    assert all(re.match(r"[-+.0-9tTfF]", t) for t, bit in texts.items() if t and bit != 64)
