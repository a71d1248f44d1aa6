"""Raw text rows to typed rows, with everything refused kept in quarantine.

Each table is one projection driven by its contract.  A row is refused for a blank
mandatory value, a literal that does not parse, an over-long text, a parent that does not
exist, or a later copy where only the latest stays; refused rows carry the first reason found
and the raw row as JSON.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.text import blank_to_null_sql, title_words_sql, truth_value_sql
from tradewind.operators.keys import group_single_keys
from tradewind.operators.numbering import number_rows, unfold
from tradewind.session import work_path
from tradewind.sources.contracts import CLEAN_TABLES, DOMAINS, Contract, Field, Reference
from tradewind.sources.tables import materialize_table

REASON = "reject_reason"
RAW_ROW = "raw_row"

# Shapes that a date or timestamp literal must have in full; a cast alone takes prefixes.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"
_SHAPES = {"date": f"^{_DAY}{_TIME}$", "timestamp_ntz": f"^{_DAY}{_TIME}$"}

_FOLDS = {
    None: lambda text: text,
    "lower": lambda text: f"lower({text})",
    "upper": lambda text: f"upper({text})",
    "title": title_words_sql,
}


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame
    refuse: Callable[[], DataFrame]

    @cached_property
    def rejects(self) -> DataFrame:
        """table_name, reason, raw_row; readers of the good rows alone do not pay for it."""
        return self.refuse()


@dataclass(frozen=True)
class LostKeys:
    """What rows of one table refer to and their parent does not hold; stored, may stand for
    the parent in `clean_table`."""

    keys: DataFrame  # the columns of the reference, distinct and filled
    repeated: Callable[[], DataFrame | None]  # parent keys with _times > 1; None if there are none


Parent = DataFrame | LostKeys


def _value(field: Field, raw: str) -> str:
    """Typed value of a field, before its default and bounds apply."""
    if field.type == "boolean":
        return truth_value_sql(raw)
    if field.type == "string":
        return _FOLDS[field.fold](f"trim({raw})" if field.blank == "keep" else blank_to_null_sql(raw))
    # A bounded small number is parsed wide first, so 99999 is lowered and not refused.
    wide = "int" if field.type == "smallint" else field.type
    filled = blank_to_null_sql(raw)
    if wide in _SHAPES:
        filled = f"CASE WHEN {filled} RLIKE r'{_SHAPES[wide]}' THEN {filled} END"
    return f"try_cast({filled} AS {wide})"


def _finished(field: Field, value: str) -> str:
    if field.default is not None:
        value = f"coalesce({value}, CAST('{field.default}' AS {field.type}))"
    for bound, clamp in ((field.low, "greatest"), (field.high, "least")):
        if bound is not None:
            # greatest/least skip NULL, so a missing value must not turn into the bound
            value = f"CASE WHEN {value} IS NOT NULL THEN {clamp}({value}, {bound}) END"
    return value if field.type == "string" else f"CAST({value} AS {field.type})"


def _reasons(field: Field, raw: str, value: str) -> list[str]:
    filled = blank_to_null_sql(raw)
    found = []
    if field.must_fill:
        found.append((f"{filled} IS NULL", "blank"))
    elif field.required and field.default is None:
        found.append((f"{raw} IS NULL", "null"))
    if field.type not in ("string", "boolean"):
        found.append((f"{value} IS NULL AND {filled} IS NOT NULL", "malformed"))
    if field.limit is not None:
        found.append((f"length({value}) > {field.limit}", "too_long"))
    return [f"CASE WHEN {broken} THEN '{why}_{field.source}' END" for broken, why in found]


def _out_of_domain(contract: Contract, values: Mapping[str, str]) -> list[str]:
    """Reasons for finished values that a declared CHECK forbids."""
    found = []
    for domain in DOMAINS:
        if domain.table == contract.name:
            field = contract.field(domain.column)
            finished = _finished(field, values[field.name])
            bounds = ((domain.low, ">="), (domain.high, "<="))
            kept = " AND ".join(f"{finished} {sign} {b}" for b, sign in bounds if b is not None)
            found.append(f"CASE WHEN NOT ({kept}) THEN 'out_of_domain_{field.source}' END")
    return found


def shape_rows(raw: DataFrame, contract: Contract) -> DataFrame:
    """Typed columns, the first reject reason (NULL for a good row) and the raw fields.

    Every field is parsed once.  The parsed values pass a generator, because a filter on the
    reason would otherwise be pushed below the projection and parse them a second time.
    The raw fields stay apart, for `raw_json`: a row that is not refused never becomes JSON.
    """
    fields = list(enumerate(contract.fields))
    parsed = [f"'_raw{i}', `{f.source}`" for i, f in fields]
    parsed += [f"'_value{i}', {_value(f, f'`{f.source}`')}" for i, f in fields]
    once = raw.selectExpr(f"inline(array(named_struct({', '.join(parsed)})))")
    values = {f.name: f"_value{i}" for i, f in fields}
    reasons = [r for i, f in fields for r in _reasons(f, f"_raw{i}", values[f.name])]
    reasons += _out_of_domain(contract, values)
    return once.selectExpr(
        *(f"{_finished(f, values[f.name])} AS `{f.name}`" for _, f in fields),
        f"coalesce({', '.join(reasons)}) AS {REASON}" if reasons else f"CAST(NULL AS string) AS {REASON}",
        *(f"_raw{i}" for i, _ in fields),
    )


def raw_json(contract: Contract) -> str:
    """The raw row of a shaped one, as JSON."""
    named = ", ".join(f"'{f.source}', _raw{i}" for i, f in enumerate(contract.fields))
    return f"to_json(named_struct({named}))"


def lost_keys(
    raw: DataFrame,
    contract: Contract,
    parents: Mapping[str, DataFrame],
    repeated: dict[str, DataFrame | None] | None = None,
) -> dict[str, LostKeys]:
    """The lost keys of every reference to be resolved, found and stored.

    Keys alone cross an exchange.  Whole rows then look up the few that are lost, which are
    broadcast while they are small, where joins with large parents would send every row
    through an exchange per parent.  Raw rows and parents should be stored.  Tables with the
    same parents can share what is found about keys that repeat in those.
    """
    repeated = {} if repeated is None else repeated
    found = {}
    for ref in contract.references:
        if ref.resolve:
            fields = [f for c in ref.columns for f in contract.fields if f.name == c]
            named = [f"{_finished(f, _value(f, f'`{f.source}`'))} AS `{f.name}`" for f in fields]
            keys = raw.selectExpr(*named).select(*ref.columns).where(_filled(ref))
            parent = _parent_keys(parents[ref.parent], ref)
            lost = keys.join(parent, list(ref.columns), "left_anti").distinct()
            path = work_path(raw.sparkSession, f"lost-{contract.name}-{ref.parent}")

            def in_parent(ref: Reference = ref, parent: DataFrame = parent) -> DataFrame | None:
                if ref.parent not in repeated:
                    repeated[ref.parent] = _repeated_parents(parent, ref)
                return repeated[ref.parent]

            found[ref.parent] = LostKeys(materialize_table(lost, path), in_parent)
    return found


def _repeated_parents(parent: DataFrame, ref: Reference) -> DataFrame | None:
    """Keys that stand more than once in a parent with their `_times`, stored."""

    def counted(part: DataFrame) -> DataFrame:
        return part.groupBy(*ref.columns).agg(F.count(F.lit(1)).alias("_times"))

    many = group_single_keys(parent.where(_filled(ref)), ref.columns, counted).where("_times > 1")
    path = work_path(parent.sparkSession, f"repeated-{ref.parent}")
    stored = materialize_table(many, path)
    return None if stored.isEmpty() else stored


def _filled(ref: Reference) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL" for c in ref.columns)


def _parent_keys(parent: DataFrame, ref: Reference) -> DataFrame:
    return parent.selectExpr(*[f"`{p}` AS `{c}`" for c, p in zip(ref.columns, ref.parent_columns)])


def clean_table(
    raw: DataFrame, contract: Contract, parents: Mapping[str, Parent] | None = None
) -> Cleaned:
    """Shape, resolve and split one table into good and refused rows; lazy.

    Good rows pass semi joins, which cannot repeat a row even if a parent key does.  The
    refused rows are found in one pass of their own, by left joins that leave a mark.  AQE
    can split a parent that owns many of the rows over several tasks in both kinds.  Through
    an exchange go the typed columns of good rows, or the parent keys, reason and raw fields
    of the others' pass; JSON is made of refused rows alone, behind all joins.  A parent given
    by its `LostKeys` is looked up the other way round.
    """
    shaped = shape_rows(raw, contract)
    names = [f.name for f in contract.fields]
    rows = _known_rows(shaped, contract, parents).select(*names)
    return Cleaned(rows, lambda: _refused_rows(shaped, contract, parents))


def _refused_rows(
    shaped: DataFrame, contract: Contract, parents: Mapping[str, Parent] | None
) -> DataFrame:
    marked, lost, times = shaped, [], []
    for ref in contract.references:
        if not ref.resolve:
            continue
        columns, parent = list(ref.columns), parents[ref.parent]
        mark = f"_has_{ref.parent}"
        if isinstance(parent, LostKeys):
            marked = marked.join(parent.keys.withColumn(mark, F.lit(False)), columns, "left")
            unknown = f"NOT {mark} OR NOT ({_filled(ref)})"
            if (many := parent.repeated()) is not None:
                # As in a join with the parent, a refused row comes once per parent row.
                found = f"_times_{ref.parent}"
                marked = marked.join(many.withColumnRenamed("_times", found), columns, "left")
                times.append(f"coalesce({found}, 1)")
        else:
            keys = _parent_keys(parent, ref).withColumn(mark, F.lit(True))
            marked = marked.join(keys, columns, "left")
            unknown = f"{mark} IS NULL"
        lost.append(f"CASE WHEN {unknown} THEN 'orphan_{ref.parent}' END")
    refused = marked.withColumn("reason", F.expr(f"coalesce({', '.join([REASON, *lost])})"))
    refused = refused.where("reason IS NOT NULL")
    if times:
        refused = unfold(refused.withColumn("_times", F.expr(" * ".join(times))), "_times")
    return quarantined(refused, contract)


def _known_rows(
    shaped: DataFrame, contract: Contract, parents: Mapping[str, Parent] | None
) -> DataFrame:
    """The shaped rows that are not refused and whose parents all exist."""
    good = shaped.where(f"{REASON} IS NULL")
    for ref in contract.references:
        if ref.resolve:
            columns, parent = list(ref.columns), parents[ref.parent]
            if isinstance(parent, LostKeys):
                good = good.where(_filled(ref)).join(parent.keys, columns, "left_anti")
            else:
                good = good.join(_parent_keys(parent, ref), columns, "left_semi")
    return good


def quarantined(rows: DataFrame, contract: Contract) -> DataFrame:
    """Shaped rows with a `reason` as rows of the quarantine."""
    return rows.selectExpr(
        f"'{contract.name}' AS table_name", "reason", f"{raw_json(contract)} AS {RAW_ROW}"
    )


def latest_per_key(rows: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key, the first under `newest_first`.

    Spark places a group limit in front of the exchange for a filter on row_number() = 1:
    each map task forwards one row per key, so a key owning a third of the rows costs the
    receiving task no more than one row per map task.
    """
    by_key = Window.partitionBy(*key).orderBy(*newest_first)
    return rows.withColumn("_nth", F.row_number().over(by_key)).where("_nth = 1").drop("_nth")


def clean_categories(raw: DataFrame) -> Cleaned:
    done = clean_table(raw, CLEAN_TABLES["category_translation"])
    return Cleaned(done.rows.distinct(), done.refuse)


def clean_customers(raw: DataFrame) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["customers"])


def clean_sellers(raw: DataFrame) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["sellers"])


def clean_products(raw: DataFrame) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["products"])


def clean_geolocation(raw: DataFrame) -> Cleaned:
    """Sample points per ZIP prefix with a dense synthetic id; equal points may repeat."""
    done = clean_table(raw, CLEAN_TABLES["geolocation"])
    return Cleaned(number_rows(done.rows, "geolocation_id"), done.refuse)


def clean_orders(raw: DataFrame, customers: Parent) -> Cleaned:
    """Orders of known customers; the lines of any other order follow it into the quarantine."""
    return clean_table(raw, CLEAN_TABLES["orders"], {"customers": customers})


def clean_order_items(
    raw: DataFrame, orders: Parent, products: Parent, sellers: Parent
) -> Cleaned:
    parents = {"orders": orders, "products": products, "sellers": sellers}
    return clean_table(raw, CLEAN_TABLES["order_items"], parents)


def clean_payments(raw: DataFrame, orders: Parent) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["order_payments"], {"orders": orders})


def _newest_review_first() -> list[Column]:
    """Equal in two reviews of one id only if they are equal in every column."""
    return [
        F.desc_nulls_last("review_creation_date"),
        F.asc("order_id"),
        F.asc_nulls_last("review_answer_timestamp"),
        F.asc("review_score"),
        F.asc_nulls_last("review_comment_message"),
        F.asc_nulls_last("review_comment_title"),
    ]


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The latest copy of each review id; the tie-breaks make the choice reproducible."""
    return latest_per_key(reviews, ["review_id"], _newest_review_first())


def superseded_rows(
    known: DataFrame, key: list[str], newest_first: list[Column], store_keys: bool = False
) -> DataFrame:
    """All rows but the first one of each key under `newest_first`; ties go by the other columns.

    A narrow count finds the keys that repeat, and only their rows go on.  Equal rows meet on
    the map side; the first of each key passes a group limit and marks its row in a join that
    AQE can split, so no task has to hold all copies of a key.  Keys must not be null.  With
    `store_keys` the repeated keys are stored first, so that while they are few they are
    broadcast and rows without copies cross no exchange; otherwise lazy.
    """
    repeated = known.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*key)
    if store_keys:
        repeated = materialize_table(repeated, work_path(known.sparkSession, "repeated-keys"))
    rows = known.join(repeated, key, "left_semi").select(*known.columns)
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ties = [F.asc_nulls_last(c) for c in known.columns]
    first = latest_per_key(copies.drop("_copies"), key, [*newest_first, *ties])
    row = F.struct(*known.columns)
    first = first.select(*key, row.alias("_kept"))
    # The rows and the kept one hold the same columns, so a null equals a null.
    left = F.col("_copies") - F.when(row.eqNullSafe(F.col("_kept")), 1).otherwise(0)
    marked = copies.join(first, key).withColumn("_left", left).where("_left > 0")
    return unfold(marked, "_left").select(*known.columns)


def clean_reviews(raw: DataFrame, orders: Parent) -> Cleaned:
    """Known orders only, then the latest copy of each review id; the others are quarantined."""
    contract, parents = CLEAN_TABLES["order_reviews"], {"orders": orders}
    done = clean_table(raw, contract, parents)

    def refuse() -> DataFrame:
        known = _known_rows(shape_rows(raw, contract), contract, parents).drop(REASON)
        stored = isinstance(orders, LostKeys)
        older = superseded_rows(known, ["review_id"], _newest_review_first(), stored)
        older = quarantined(older.withColumn("reason", F.lit("superseded_review_id")), contract)
        return done.rejects.unionByName(older)

    return Cleaned(latest_reviews(done.rows), refuse)


def clean_leads(raw: DataFrame) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["qualified_leads"])


def clean_deals(raw: DataFrame, leads: Parent) -> Cleaned:
    return clean_table(raw, CLEAN_TABLES["closed_deals"], {"qualified_leads": leads})


def clean_parents(raw: Mapping[str, DataFrame]) -> dict[str, Cleaned]:
    """Tables whose rows need no other table to exist."""
    return {
        "category_translation": clean_categories(raw["category_translation"]),
        "customers": clean_customers(raw["customers"]),
        "sellers": clean_sellers(raw["sellers"]),
        "products": clean_products(raw["products"]),
        "geolocation": clean_geolocation(raw["geolocation"]),
        "qualified_leads": clean_leads(raw["qualified_leads"]),
    }


def clean_ordered(
    raw: Mapping[str, DataFrame], parents: Mapping[str, DataFrame], store_lost: bool = False
) -> dict[str, Cleaned]:
    """Orders: children of customers and parents of lines, payments and reviews."""
    return {"orders": clean_child(raw, "orders", parents, store_lost)}


def clean_children(
    raw: Mapping[str, DataFrame], parents: Mapping[str, DataFrame], store_lost: bool = False
) -> dict[str, Cleaned]:
    """Tables whose rows must resolve; hand in stored parents to read only their keys."""
    names, repeated = [n for n in CHILDREN if n != "orders"], {}
    return {n: clean_child(raw, n, parents, store_lost, repeated) for n in names}


CHILDREN = {
    "orders": clean_orders,
    "order_items": clean_order_items,
    "order_payments": clean_payments,
    "order_reviews": clean_reviews,
    "closed_deals": clean_deals,
}


def clean_child(
    raw: Mapping[str, DataFrame],
    name: str,
    parents: Mapping[str, DataFrame],
    store_lost: bool = False,
    repeated: dict[str, DataFrame | None] | None = None,
) -> Cleaned:
    """One table whose rows must resolve; with `store_lost` by its `lost_keys`, else lazy."""
    contract = CLEAN_TABLES[name]
    known = {r.parent: parents[r.parent] for r in contract.references if r.resolve}
    if store_lost:
        known = lost_keys(raw[name], contract, known, repeated)
    return CHILDREN[name](raw[name], *known.values())


def rows_of(cleaned: Mapping[str, Cleaned]) -> dict[str, DataFrame]:
    return {name: c.rows for name, c in cleaned.items()}


def quarantine_rejects(*groups: Mapping[str, Cleaned]) -> DataFrame:
    """All refused rows: table_name, reason, raw_row."""
    return reduce(DataFrame.unionByName, [c.rejects for g in groups for c in g.values()])


def clean_all(raw: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table and the quarantine, without storing anything in between."""
    parents = clean_parents(raw)
    orders = clean_ordered(raw, rows_of(parents))
    known = {**rows_of(parents), **rows_of(orders)}
    children = clean_children(raw, known)
    return {**known, **rows_of(children)}, quarantine_rejects(parents, orders, children)
