"""Silver layer: typing, cleansing, reshaping and deduplication.

Contract of the tidy Silver table (one row per observation)::

    source string, indicator string, region string, period date (month start),
    measure string, value decimal(18,4)

Key: every column except ``value``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE_TYPE = "decimal(18,4)"
TIDY_COLUMNS = ("source", "indicator", "region", "period", "measure", "value")

# Texts that mean "no value" in the landed sources (ours).
PLACEHOLDERS = ("", "-", ".", "..", "...", "NA", "N/A", "NULL", "NONE", "NAN")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy(df: DataFrame, source, indicator, region, period, measure, value,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """Project any frame onto the tidy contract.

    Each argument is a ``Column`` or a constant; a plain string is always a
    constant (pass ``F.col(name)`` for a column).  ``keep`` passes extra
    columns through (e.g. the load stamp used by ``latest_observations``).
    """
    def as_col(v):
        return v if isinstance(v, Column) else F.lit(v)
    return df.select(
        as_col(source).cast("string").alias("source"),
        as_col(indicator).cast("string").alias("indicator"),
        as_col(region).cast("string").alias("region"),
        F.trunc(as_col(period).cast("date"), "month").alias("period"),
        as_col(measure).cast("string").alias("measure"),
        as_col(value).cast(VALUE_TYPE).alias("value"),
        *[F.col(c) for c in keep],
    )


# ── P10 type enforcement ───────────────────────────────────────────────────

def parse_as(raw: Column, target: str, decimal_comma: bool = False,
             fmt: str | None = None) -> Column:
    """Text -> ``target`` type, NULL when the text does not parse (never raises)."""
    text = F.trim(raw)
    t = target.lower()
    if t.startswith("decimal") or t in ("double", "float", "int", "bigint", "smallint"):
        if decimal_comma:
            # dots only as well-formed grouping; any other text is no number
            grouped = text.rlike(r"^[+-]?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$")
            plain = F.regexp_replace(F.regexp_replace(text, r"\.", ""), ",", ".")
            text = F.when(grouped, plain)
        return text.try_cast(target)
    if t == "date":
        return F.to_date(F.try_to_timestamp(text, F.lit(fmt))) if fmt else text.try_cast("date")
    if t.startswith("timestamp"):
        return F.try_to_timestamp(text, F.lit(fmt)) if fmt else text.try_cast(target)
    if t == "boolean":
        return text.try_cast("boolean")
    return text.cast(target)


def enforce_types(df: DataFrame, contract: dict[str, str], decimal_comma: bool = False,
                  formats: dict[str, str] | None = None) -> DataFrame:
    """Typed frame plus a ``_rejects`` array of ``(column, raw, target)`` for
    every non-empty text that failed to parse.  Nothing is dropped silently:
    ``typed_rows`` / ``reject_rows`` split the two outputs of one pass."""
    formats = formats or {}
    typed_cols, reject_items = [], []
    for c in df.columns:
        if c not in contract:
            typed_cols.append(F.col(c))
            continue
        raw = F.col(c).cast("string")
        parsed = parse_as(raw, contract[c], decimal_comma, formats.get(c))
        typed_cols.append(parsed.alias(c))
        failed = parsed.isNull() & F.nullif(F.trim(raw), F.lit("")).isNotNull()
        reject_items.append(F.when(failed, F.struct(
            F.lit(c).alias("column"), raw.alias("raw"), F.lit(contract[c]).alias("target"))))
    rejects = F.filter(F.array(*reject_items), lambda x: x.isNotNull()) if reject_items \
        else F.array().cast("array<struct<column:string,raw:string,target:string>>")
    return df.select(*typed_cols, rejects.alias("_rejects"))


def typed_rows(enforced: DataFrame) -> DataFrame:
    return enforced.drop("_rejects")


def reject_rows(enforced: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row per failed value: ``key…, column, raw, target``."""
    return (enforced.select(*key_cols, F.explode("_rejects").alias("r"))
            .select(*key_cols, "r.column", "r.raw", "r.target"))


# ── P11 cleansing ──────────────────────────────────────────────────────────

def cleanse_text(c) -> Column:
    """Trim, collapse inner blanks to one space, placeholder marks -> NULL."""
    s = F.trim(F.regexp_replace(_col(c), r"\s+", " "))
    return F.when(F.upper(s).isin(*PLACEHOLDERS), F.lit(None).cast("string")).otherwise(s)


# ── P12 type verification ─────────────────────────────────────────────────

def verify_types(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per contract column: declared vs actual type, NULL count and
    count of values that do not cast to the declared type.

    All counts come from one aggregate pass (partial aggregation on every
    task), then the single wide row is unpivoted.
    """
    aggs, rows = [], []
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for i, f in enumerate(contract.fields):
        exp = f.dataType.simpleString()
        if f.name in df.columns:
            c = F.col(f.name)
            aggs += [F.count_if(c.isNull()).alias(f"n{i}"),
                     F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull()).alias(f"f{i}")]
            nulls, fails = F.col(f"n{i}"), F.col(f"f{i}")
        else:
            nulls, fails = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        rows.append(F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
            F.lit(exp).alias("expected_type"),
            F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
            F.lit(actual.get(f.name) == exp).alias("type_ok"),
            nulls.cast("bigint").alias("null_count"),
            fails.cast("bigint").alias("cast_failures")))
    counts = df.agg(*aggs) if aggs else df.limit(0).agg(F.count(F.lit(1)))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ── P13 run scope ─────────────────────────────────────────────────────────

def apply_scope(df: DataFrame, period_col: str, scope: str = "full_history") -> DataFrame:
    """``full_history`` keeps everything; ``since=YYYY-MM`` keeps periods from
    that month on.  The literal is cast to the column's own type so the
    comparison stays a plain predicate the Parquet scan can push down."""
    if scope in (None, "", "full_history"):
        return df
    if not scope.startswith("since="):
        raise ValueError(f"unknown data_scope {scope!r}")
    month = scope.split("=", 1)[1]
    start = F.lit(f"{month}-01" if len(month) == 7 else month)
    return df.where(F.col(period_col) >= start.cast(df.schema[period_col].dataType))


# ── R2 unpivot ────────────────────────────────────────────────────────────

def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str],
                     value_type: str = VALUE_TYPE, drop_blank: bool = False) -> DataFrame:
    """Crosstab -> tidy ``ids…, measure, value``; blanks kept unless asked."""
    cast = df.select(*ids, *[F.col(m).cast(value_type).alias(m) for m in measures])
    out = cast.unpivot(ids, measures, "measure", "value")
    return out.where(F.col("value").isNotNull()) if drop_blank else out


# ── R4 / U1 / U2 consolidation ────────────────────────────────────────────

def consolidate(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ── A6 deduplication ──────────────────────────────────────────────────────

def dedup_latest(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order_by``, ties broken by the
    greatest of the remaining columns (a total order, so both engines and
    every rerun keep the same row).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit: every
    task keeps only its best row per key *before* the shuffle, so a hot key
    arrives at its reducer as one row per task, not as its whole history.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by + rest])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def superseded(df: DataFrame, keys: list[str], order: str) -> Column:
    """Whether a later load (by ``order``) holds the row's key, too.

    All rows of a key's latest load are current: a document may hold several
    observations of one key.  To be used in a projection over ``df``; one
    shuffle on the keys, which hold as many rows as there were loads of one
    observation."""
    latest = F.max(order).over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]))
    return F.coalesce(F.col(order) < latest, F.lit(False))


def history(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Older versions of each key: ``keys…, versions array<struct<values…>>,
    valid_from, valid_to``.

    The version of a load are the values of all its rows of the key.  A load
    that repeats the version before it opens no new one; the latest version of
    a key isn't listed.  Rows are dealt out by key and sorted once: the
    versions are gathered and compared in that order."""
    # a hash goes first: rows are dealt out by it alone, constant keys or not, and sorted by numbers
    rows = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_hash"), *[F.col(f"`{k}`") for k in keys],
                     order, F.struct(*values).alias("_row")).repartition("_hash")
    key = ["_hash", *[F.col(f"`{k}`") for k in keys]]
    load = Window.partitionBy(*key, order).orderBy("_row")
    whole = load.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    loads = rows.select("*", F.collect_list("_row").over(whole).alias("versions"),
                        F.row_number().over(load).alias("_nth")).where("_nth = 1").drop("_row", "_nth")
    w = Window.partitionBy(*key).orderBy(order)
    first = F.lag(order).over(w).isNull()
    changed = loads.withColumn("_new", first | ~F.lag("versions").over(w).eqNullSafe(F.col("versions"))).where("_new")
    closed = changed.withColumn("valid_to", F.lead(order).over(w)).where(F.col("valid_to").isNotNull())
    return closed.select(*[F.col(f"`{k}`") for k in keys], "versions", F.col(order).alias("valid_from"), "valid_to")


def roll_up(rows: DataFrame, keys: list[str], additive: Column, value: str = "value") -> DataFrame:
    """One row per key: the sum of its values where ``additive`` (a function
    of the keys), else their exact mean, rounded half up; NULL flags fail the
    job."""
    flag = F.coalesce(additive, F.raise_error(F.concat(
        F.lit("measure without additive flag: "), F.to_json(F.struct(*keys)))).cast("boolean"))
    both = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"), F.avg(value).alias("_mean"))
    return both.select(*keys, F.when(flag, F.col("_sum").cast(VALUE_TYPE)).otherwise(
        F.col("_mean").cast(VALUE_TYPE)).alias(value))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop exact copies (all columns)."""
    return df.dropDuplicates()


# ── J2 lookup mapping ─────────────────────────────────────────────────────

def _targets(mapping: DataFrame, on: str, target: str, key: Callable[[Column], Column]) -> DataFrame:
    """``_name`` (as it compares), ``targets``, ``names``: what a lookup says of each name."""
    return mapping.where(F.col(on).isNotNull()).groupBy(key(F.col(on)).alias("_name")).agg(
        F.sort_array(F.collect_set(F.struct(target))).alias("targets"), F.sort_array(F.collect_set(on)).alias("names"))


def _same(name: Column) -> Column:
    return name


def name_conflicts(mapping: DataFrame, on: str, target: str, key: Callable[[Column], Column] = _same) -> DataFrame:
    """Names that a lookup gives several targets (a missing one counts):
    ``name`` as it compares, the ``names`` as they are written, ``targets``."""
    return _targets(mapping, on, target, key).where(F.size("targets") > 1).select(
        F.col("_name").alias("name"), "names", F.col(f"targets.{target}").alias("targets"))


def map_values(df: DataFrame, mapping: DataFrame, on: str, target: str,
               key: Callable[[Column], Column] = _same) -> DataFrame:
    """Left join to a lookup; an unmapped name keeps the row with NULL target.

    Names are equal if ``key`` makes them so (``functions.fold_name`` passes
    over case, marks and articles).  A name of ``df`` for which the lookup has
    several targets fails the job (see ``name_conflicts`` for a report);
    entries that repeat each other are one."""
    clash = F.raise_error(F.concat(F.lit("several targets for the name "), F.col("_name"), F.lit(": "),
                                   F.to_json("targets"))).cast(mapping.schema[target].dataType)
    one = _targets(mapping, on, target, key).select("_name", F.when(F.size("targets") > 1, clash).otherwise(
        F.col("targets")[0][target]).alias(target))
    return df.withColumn("_name", key(F.col(on))).join(one, on="_name", how="left").drop("_name")


def unmapped(df: DataFrame, mapping: DataFrame, on: str, key: Callable[[Column], Column] = _same) -> DataFrame:
    """Names with no lookup entry and how many rows carry each."""
    m = mapping.select(key(F.col(on)).alias("_name")).distinct()
    return (df.withColumn("_name", key(F.col(on))).join(m, on="_name", how="left_anti").groupBy(on)
            .agg(F.count(F.lit(1)).alias("n_rows")))
