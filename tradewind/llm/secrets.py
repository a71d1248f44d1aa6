"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is a blob, named by its SHA-256.  The ledger remembers which
(blob, rule version) pairs were scanned and what they gave; a scan runs only the pairs it has
not seen, and findings are joined back to all rows (paths) that hold the blob.  Everything is
DataFrame functions.

Defined results: a null text is an empty one; rows may repeat and share ids, each gets its own
result; other columns, whatever their names, pass through `attach_spans`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import fresh, table


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if group `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules.  In `access` and `hex` the least length stands in the
# pattern: a run of one character class is matched whole or, if too short, nowhere, so this
# gives the same spans and leaves out the many short runs.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Public token formats beyond the base.
EXTRA_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + EXTRA_RULES

_HIT = "struct<rule string, at int, gap int, span int, value int>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _hits(text: Column, rule: Rule) -> Column:
    """Lengths of each match and of the text before it, in order.

    Only lengths leave this step, so a blob's row stays small; starts follow as running
    sums, by a window over the exploded rows, because a sum inside the array would take
    quadratic time in a text with very many matches.
    """
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("span"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("value"),
    )
    lengths = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(rule.key).alias("rule"),
            i.alias("at"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["span"]).alias("span"),
            F.length(x["value"]).alias("value"),
        ),
    )
    return F.when(text.rlike(rule.pattern), lengths).otherwise(F.array().cast(f"array<{_HIT}>"))


def scan_blobs(docs: DataFrame, text: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Append to the ledger what the unseen (blob, rule version) pairs give.

    A blob that many rows hold is scanned once: copies meet on the map side first.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    blobs = docs.select(blob_of(F.col(text)).alias("blob"), whole.alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    asked = F.array(*(F.lit(r.key) for r in rules))
    known = read_ledger(spark, ledger)
    if known is not None:
        seen = known.groupBy("blob").agg(F.flatten(F.collect_set("scanned")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
        todo = F.array_except(asked, F.coalesce("seen", F.array().cast("array<string>")))
    else:
        todo = asked
    blobs = blobs.withColumn("scanned", todo).where(F.size("scanned") > 0)
    found = F.flatten(
        F.array(
            *(
                F.when(F.array_contains("scanned", r.key), _hits(F.col("text"), r)).otherwise(
                    F.array().cast(f"array<{_HIT}>")
                )
                for r in rules
            )
        )
    )
    blobs.select("blob", "scanned", found.alias("hits")).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, None before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    return spark.read.schema(f"blob binary, scanned array<string>, hits array<{_HIT}>").parquet(
        ledger
    )


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): kind order, start and end of each finding of these rule versions."""
    by_key = {r.key: (i, r) for i, r in enumerate(rules)}

    def of_rule(value) -> Column:
        column = F.lit(None).cast("int")
        for key, (i, r) in by_key.items():
            column = F.when(F.col("h.rule") == key, F.lit(value(i, r))).otherwise(column)
        return column

    # A pair scanned twice, say by two runs side by side, gives equal rows: one is kept.
    hits = ledger.select("blob", F.explode("hits").alias("h"))
    hits = hits.where(F.col("h.rule").isin(*by_key)).select("blob", "h").distinct()
    ordered = Window.partitionBy("blob", "h.rule").orderBy("h.at")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("h.gap").over(ordered) + F.coalesce(F.sum("h.span").over(before), F.lit(0))
    spans = hits.withColumn("start", start).where(
        F.col("h.span").isNotNull() & (F.col("h.value") >= of_rule(lambda i, r: r.least))
    )
    span = F.struct(
        "start",
        of_rule(lambda i, r: i).alias("kind"),
        (F.col("start") + F.col("h.span")).alias("end"),
    )
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


# Cells of blobs with findings that are known to all tasks.
CELLS = 1 << 20
_SPANS = "array<struct<start bigint, kind int, end bigint>>"


def attach_spans(
    docs: DataFrame,
    text: str,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    keep: list[str] | None = None,
    into: str = "spans",
) -> DataFrame:
    """Scan what is new, then give every row the findings of its blob (an empty list if none).

    `keep`: columns to return, all by default.  Many rows of one blob are a hot join key; the
    findings are written down first, so both sides of the join have an exchange that adaptive
    execution can split.  Where the text is kept, only rows whose blob shares one of CELLS cells
    with a blob that has findings go through that exchange; the others stay where they are.
    """
    spark = docs.sparkSession
    scan_blobs(docs, text, ledger, rules)
    found = findings(read_ledger(spark, ledger), rules)
    path = scratch_path(spark, "findings")
    found.write.parquet(path)
    blob, there, cell = fresh("blob"), fresh("spans"), fresh("cell")
    found = spark.read.schema(f"blob binary, spans {_SPANS}").parquet(path)
    found = found.select(F.col("blob").alias(blob), F.col("spans").alias(there))
    keep = docs.columns if keep is None else keep
    paths = docs.withColumn(blob, blob_of(F.col(text))).select(*keep, blob)
    none = F.array().cast(_SPANS)
    if text not in keep:
        joined = paths.join(found, blob, "left")
        return joined.select(*keep, F.coalesce(F.col(there), none).alias(into))
    paths = paths.withColumn(cell, F.pmod(F.xxhash64(blob), F.lit(CELLS)))
    # At most CELLS rows.
    cells = F.broadcast(found.select(F.pmod(F.xxhash64(blob), F.lit(CELLS)).alias(cell)).distinct())
    joined = paths.join(cells, cell, "left_semi").join(found, blob, "left")
    joined = joined.select(*keep, F.coalesce(F.col(there), none).alias(into))
    others = paths.join(cells, cell, "left_anti").select(*keep, none.alias(into))
    return joined.unionAll(others)


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.concat_ws(",", one)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by a mark."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        more = F.when(
            s["start"] >= done["at"], F.concat(done["out"], F.array(gap, F.lit(mark)))
        ).otherwise(done["out"])
        return F.struct(more.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    def finish(done: Column) -> Column:
        rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
        return F.concat_ws("", done["out"], F.array(rest))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned through a fresh ledger."""
    docs = table(spark, sf_dir, "documents")
    found = attach_spans(docs, "text", scratch_path(spark, "ledger"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
