"""CSV landing: raw text layer, optional inferred layer, header repair."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import ship_package
from tradewind.sources.contracts import CLEAN_TABLES, HEADER_ALIASES, Contract

_CSV = {"quote": '"', "escape": '"', "emptyValue": "", "mode": "FAILFAST"}
# Stands for an unquoted empty field inside the parser, so that "" stays a text.
_NO_VALUE = "\x00no value\x00"


def load_staging_csv(
    spark: SparkSession,
    folder: str,
    table: str | Contract,
    path: str | None = None,
) -> DataFrame:
    """One raw extract as all-text columns, header skipped, columns taken by position.

    An unquoted empty field is NULL and a quoted one is the empty string.  Tables whose text
    may hold line breaks go through `quoted_records`, so that every file can be read by many
    tasks; a row with too few or too many fields stops the job.
    """
    contract = CLEAN_TABLES[table] if isinstance(table, str) else table
    path = path or f"{folder.rstrip('/')}/{contract.file_pattern}"
    schema = contract.raw_schema()
    if contract.multiline:
        fields = F.from_csv("record", ", ".join(f"`{n}` string" for n in schema.fieldNames()), _CSV | {"nullValue": _NO_VALUE})
        return quoted_records(spark, path).select(fields.alias("row")).select("row.*")
    return spark.read.schema(schema).options(header=True, nullValue=None, **_CSV).csv(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line): block is where the task's byte range of the file begins."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, block, odd, open): whether a quoted field is open where a range begins and ends.

    A light pass counts the quotes of each range; the running parity over the ranges of a file
    is a window over one row per range.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    of_file = Window.partitionBy("file")
    upto = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("quotes").over(of_file)
    upto = F.when(total % 2 == 0, F.sum("quotes").over(upto)).otherwise(
        F.raise_error(F.lit("a quoted field does not end with its file"))
    )
    return counted.select(
        "file", "block", ((upto - F.col("quotes")) % 2 == 1).alias("odd"), (upto % 2 == 1).alias("open")
    )


_PIECES = "file long, block long, place int, record string"
_WHOLE, _HEAD, _TAIL = range(3)


def _assemble(
    batches: Iterator[pa.RecordBatch], wanted: tuple[int, ...], header: bool
) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, in order -> records; what belongs to other ranges too is a head or a tail."""
    held: list[str] = []
    at = None
    odd = head = skip = False

    def ended(open_end: bool) -> list[tuple[int, str]]:
        """What is held when a record starts or its range ends."""
        nonlocal skip
        out = [(_HEAD if head else _TAIL if open_end else _WHOLE, "\n".join(held))] if held and not skip else []
        skip = skip and not held
        held.clear()
        return out

    def batch_of(range_of, rows) -> pa.RecordBatch:
        rows = [(p, r) for p, r in rows if p in wanted]
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([range_of[0]] * n, pa.int64()), pa.array([range_of[1]] * n, pa.int64()),
             pa.array([p for p, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.string())],
            names=["file", "block", "place", "record"],
        )

    for batch in batches:
        files, blocks = (batch.column(c).to_numpy() for c in ("file", "block"))
        quotes = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False)
        lines = batch.column("line").to_pylist()
        edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
            if a == b:
                continue
            found: list[tuple[int, str]] = []
            if at != (files[a], blocks[a]):
                if at is not None:
                    yield batch_of(at, ended(odd))
                at, odd = (int(files[a]), int(blocks[a])), bool(batch.column("odd")[a].as_py())
                head, skip = odd, header and at[1] == 0
            # Whether a quoted field is open before each line.
            flips = np.cumsum(quotes[a:b]) + odd
            inside = np.concatenate([[odd], flips[:-1] % 2 == 1])
            for line, within in zip(lines[a:b], inside.tolist(), strict=True):
                if not within:
                    found += ended(False)
                    head = False
                held.append(line)
            odd = bool(flips[-1] % 2)
            yield batch_of(at, found)
    if at is not None:
        yield batch_of(at, ended(odd))


def quoted_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): the rows of CSV files whose quoted fields may hold line breaks, as text.

    Every file is read in byte ranges by as many tasks as its size asks for.  A line starts a
    record if an even number of quotes stands before it in its file, so a range needs to know
    the parity at its start (`_ranges`, one row per range, hence bounded by bytes divided by
    `spark.sql.files.maxPartitionBytes`, and broadcast: a join by exchange would lose the order
    of lines).  Records within a range leave its task whole; the few that cross its borders are
    put together by a grouping over the pieces.  Quotes inside a field must be doubled, and the
    field quoted; a file whose quotes do not match stops the job.
    """
    ship_package(spark)
    lines = _lines(spark, path)
    ranges = F.broadcast(_ranges(lines))
    placed = lines.join(ranges, ["file", "block"])

    def pieces(rows: DataFrame, *wanted: int) -> DataFrame:
        return rows.select("file", "block", "odd", "line").mapInArrow(
            lambda batches: _assemble(batches, wanted, header), _PIECES
        )

    whole = pieces(placed, _WHOLE)
    torn = pieces(placed.where(F.col("odd") | F.col("open")), _HEAD, _TAIL)
    order = Window.partitionBy("file").orderBy("block", "place")
    chain = F.count_if(F.col("place") == _TAIL).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
    # Heads without a tail before them belong to a header that crosses a border.
    joined = torn.withColumn("chain", chain).where("chain > 0").groupBy("file", "chain").agg(
        F.concat_ws("\n", F.transform(parts, lambda p: p.record)).alias("record")
    )
    records = whole.select("record").unionAll(joined.select("record"))
    ended = F.regexp_replace("record", "\r$", "")
    return records.select(ended.alias("record")).where(F.trim("record") != "")


def load_staging(
    spark: SparkSession, folder: str, paths: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """All eleven raw extracts of a folder."""
    paths = paths or {}
    return {name: load_staging_csv(spark, folder, name, paths.get(name)) for name in CLEAN_TABLES}


def load_inferred_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with column types inferred from every row rather than a sample.

    Costs a second pass over the files; the text layer is the default route.  Timestamps
    are read without a zone, so the session's zone cannot move or reject an hour.
    """
    reader = (
        spark.read.option("header", True)
        .option("preferDate", True)
        .option("multiLine", multiline)
        .option("escape", '"')
    )
    inferred = reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path).schema
    zoneless = T.StructType()
    for f in inferred.fields:
        is_instant = isinstance(f.dataType, T.TimestampType)
        zoneless = zoneless.add(f.name, T.TimestampNTZType() if is_instant else f.dataType)
    return reader.schema(zoneless).csv(path)


# What a text can be read as, one bit each, and the types that hold sets of such texts, narrowest
# first.  The bits of all texts of a column combine by OR, in any order.
_SHAPE_BITS = (
    ("int", 1, r"^[+-]?[0-9]+$"),
    ("bigint", 2, r"^[+-]?[0-9]+$"),
    ("double", 4, r"^[+-]?([0-9]+[.][0-9]*|[.]?[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", 8, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("timestamp_ntz", 16, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"),
    ("boolean", 32, r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"),
)
_TEXT_BIT = 64
# The characters that texts of these shapes begin with, and the shapes with a dash in fifth place.
_SHAPE_FIRSTS = "+-.0123456789tTfF"
_DASHED = ("date", "timestamp_ntz")
_HOLDS = (("int", 1), ("bigint", 3), ("double", 7), ("date", 8), ("timestamp_ntz", 24), ("boolean", 32))


def _shape_bit(text: str) -> str:
    """The bit of the narrowest type that a text can be read as; 0 for a missing or empty one.

    A whole number beyond 64 bits is text: no other type here keeps all its digits.  Patterns are
    dear, so single characters decide first: most texts begin with none of the characters that a
    shape can begin with, and only days and instants have a dash behind four characters (or a
    number its exponent's, which fits no day).
    """
    firsts = ", ".join(f"'{c}'" for c in _SHAPE_FIRSTS)
    cases = [
        f"WHEN {text} IS NULL OR {text} = '' THEN 0",
        f"WHEN substr({text}, 1, 1) NOT IN ({firsts}) THEN {_TEXT_BIT}",
    ]
    # Days and instants fit no other shape, so it makes no difference that they are asked first.
    for kind, bit, shape in sorted(_SHAPE_BITS, key=lambda s: s[0] not in _DASHED):
        dash = f"substr({text}, 5, 1) = '-' AND " if kind in _DASHED else ""
        cases.append(f"WHEN {dash}{text} RLIKE r'{shape}' AND try_cast({text} AS {kind}) IS NOT NULL THEN {bit}")
        if kind == "bigint":
            cases.append(f"WHEN {text} RLIKE r'{shape}' THEN {_TEXT_BIT}")
    return f"CASE {' '.join(cases)} ELSE {_TEXT_BIT} END"


def infer_types(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """The narrowest type of every column of text tables, from all their rows.

    One job over all tables: a row per table holds the combined bits of its columns.  Partial
    results merge on the map side, so every file is read by as many tasks as its text is.
    """
    found = [
        rows.agg(
            F.lit(name).alias("table"),
            F.array(*(F.bit_or(F.expr(_shape_bit(f"`{c}`"))) for c in rows.columns)).alias("bits"),
        )
        for name, rows in tables.items()
    ]
    if not found:
        return {}
    seen = {r["table"]: r["bits"] for r in reduce(DataFrame.unionAll, found).collect()}
    return {
        name: {c: _narrowest(bits or 0) for c, bits in zip(rows.columns, seen[name], strict=True)}
        for name, rows in tables.items()
    }


def _narrowest(bits: int) -> str:
    fits = (kind for kind, held in _HOLDS if bits and not bits & ~held)
    return next(fits, "string")


def load_inferred(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The extracts with inferred types and the raw layer's spellings; points excluded.

    Types come from the staged text, line breaks in quoted fields included, in one job for all
    files; an empty text is a missing value in any column that is not text.
    """
    texts = {n: load_staging_csv(spark, folder, n) for n in CLEAN_TABLES if n != "geolocation"}

    def typed(column: str, kind: str) -> str:
        if kind == "string":
            return f"`{column}`"
        return f"CAST(nullif(`{column}`, '') AS {kind}) AS `{column}`"

    types = infer_types(texts)
    return {n: rows.selectExpr(*(typed(c, k) for c, k in types[n].items())) for n, rows in texts.items()}


def normalize_headers(df: DataFrame, aliases: Mapping[str, str] = HEADER_ALIASES) -> DataFrame:
    """Rename accepted header spellings to the raw layer's; other columns stay."""
    present = set(df.columns)
    renames = {
        seen: wanted for seen, wanted in aliases.items() if seen in present and wanted not in present
    }
    return df.withColumnsRenamed(renames)
