"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each document of a source expects ``target / source_size`` copies.  In the order of size, the expected copies are
summed up; a document is emitted once for each integer that its span of the sum (moved by one offset per source)
crosses.  Since neighbours in that order have like sizes, a source's words come within about its largest document of
the target.

No window sees a whole source: ranks are made of counts per (source, size), then per (source, size, salt), and only
the documents of one salt are ordered together; equal documents are one counted row until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import WORD, unused
from indicata.sinks.files import materialize

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
#: Hex digits of the digest that salts a (source, size): 4,096 parts, so a third of all rows on one size still splits.
SALT_DIGITS = 3


def unit(text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the text and the seed only."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), text)), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)


def targets(totals: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``: ``share`` of all sizes by the weights, which repeat
    over the sources in code point order (null last); a target above ``most`` times its source's size stops there and
    the excess goes to the others by weight, until none is above.

    The windows run over one row per source.  In the order of ``most * size / weight`` the stopped sources come first,
    so the level of the others is the first, and highest, that its own source stays under.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (place + 1).cast("int"))
    by_stop = Window.orderBy((F.lit(most) * F.col("source_size") / F.col("weight")),
                             F.col("source").asc_nulls_last())
    before, rest = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = totals.withColumn("weight", weight).withColumn(
        "stopped_before", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))).withColumn(
        "weight_left", F.sum("weight").over(rest)).withColumn("all_size", F.sum("source_size").over(whole))
    level = (F.col("all_size") * F.lit(share) - F.col("stopped_before")) / F.col("weight_left")
    rows = rows.withColumn("level", F.when(F.col("source_size") * most >= F.col("weight") * level, level))
    rows = rows.withColumn("level", F.max("level").over(whole))
    return rows.select("source", "source_size", F.least(
        (F.col("source_size") * most).cast("double"),
        F.coalesce(F.col("weight") * F.col("level"), F.lit(float("inf")))).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
        **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row: its words, those of its source, its
    source's target, how often the mix holds the document (0, 1 or 2) and the words taken by that.

    Null and empty texts have size 0 and are counted like any other (no words are taken).  Null sources are one
    source, null ids one id.  Rows with equal source, size and id are interchangeable; of those, the mix takes as many
    as the integers crossed.  An empty table gives no rows; a source of size 0 has target 0.
    """
    sized = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    alike = sized.groupBy("source", "size", "doc_id").agg(F.count(F.lit(1)).alias("m"))
    alike = materialize(alike, "mix-sizes")  # the only pass over the texts; everything below reads these small rows
    alike = alike.withColumn("salt", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1,
                                                 SALT_DIGITS))
    cells = alike.groupBy("source", "size", "salt").agg(F.sum("m").alias("n"))
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goal = targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), **shares)

    def running(by: list[str], order: list[str]) -> Column:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    same = lambda a, b, *names: [a[x].eqNullSafe(b[x]) for x in names]
    sizes = sizes.withColumn("before_size", running(["source"], ["size"]))
    sizes = sizes.join(goal, same(sizes, goal, "source")).select(
        sizes["source"], sizes["size"], "before_size", "source_size", "target")
    cells = cells.withColumn("before_cell", running(["source", "size"], ["salt"]))
    cells = cells.join(sizes, same(cells, sizes, "source", "size")).select(
        cells["source"], cells["size"], "salt", (F.col("before_size") + F.col("before_cell")).alias("before"),
        "source_size", "target")
    alike = alike.withColumnRenamed("m", "n").withColumn(
        "before_doc", running(["source", "size", "salt"], ["doc_id"]))
    rows = alike.join(cells, same(alike, cells, "source", "size", "salt")).select(
        alike["source"], alike["size"], "doc_id", "n", (F.col("before") + F.col("before_doc")).alias("before"),
        "source_size", "target")
    each = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("before") + F.col("i")
    offset = unit(F.coalesce(F.col("source"), F.lit("")), seed)
    crossed = F.floor(per * (at + 1) + offset) - F.floor(per * at + offset)
    return each.select("doc_id", "source", "size", "source_size", "target", crossed.alias("copies"),
                       (crossed * F.col("size")).alias("taken"))


def oracle(share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> str:
    """The same mix of ``documents`` in one SQL statement with plain windows over whole sources."""
    cases = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(weights))
    digits = f"('0x' || substr(md5('{seed}:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    return f"""
    WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size
                   FROM documents),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {cases} END AS w
                FROM totals),
    stops AS (SELECT *, coalesce(sum(source_size * {most}) OVER (ORDER BY {most} * source_size / w, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stopped,
                     sum(w) OVER (ORDER BY {most} * source_size / w, source NULLS LAST
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS w_left,
                     (sum(source_size) OVER ())::BIGINT AS all_size FROM weighed),
    levels AS (SELECT *, (all_size * {share}::DOUBLE - stopped) / w_left AS lv FROM stops),
    goal AS (SELECT source, source_size, least((source_size * {most})::DOUBLE, coalesce(w *
                    (max(CASE WHEN source_size * {most} >= w * lv THEN lv END) OVER ()), 'inf'::DOUBLE)) AS target
             FROM levels),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size,
                      substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {SALT_DIGITS}), doc_id NULLS FIRST) - 1 AS nth FROM sized),
    crossed AS (SELECT r.doc_id, r.size, g.source_size, g.target,
                       CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS per, r.nth,
                       {digits.replace("source", "r.source")} AS u
                FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
           ((floor(per * (nth + 1) + u) - floor(per * nth + u))::BIGINT * size)::BIGINT AS taken FROM crossed"""


def take(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as ``mixed`` (their ``mix``) has it.

    Where ids repeat, the copies of an id are dealt over its rows in order of their hash, equal rows counted together,
    so that the copies of equal ids add up, though not by size.  Other columns may have any names.
    """
    p = unused(docs.columns)
    id_, m, copies, i, n, at, k = (p + x for x in ("id", "m", "copies", "i", "n", "at", "k"))
    counts = materialize(mixed.groupBy(F.col("doc_id").alias(id_)).agg(
        F.count(F.lit(1)).alias(m), F.sum("copies").alias(copies)), "mix-copies")
    own, columns = F.col(f"`{key}`"), [docs[f"`{c}`"] for c in docs.columns]
    once = docs.join(counts.where((F.col(m) == 1) & (F.col(copies) > 0)), own.eqNullSafe(F.col(id_))).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(i))
    out = once.drop(i)
    more = counts.where(F.col(m) > 1)
    if more.isEmpty():
        return out
    again = docs.join(more, own.eqNullSafe(F.col(id_))).groupBy(*columns, id_, m, copies).agg(
        F.count(F.lit(1)).alias(n))
    order = Window.partitionBy(id_).orderBy(F.xxhash64(*[f"`{c}`" for c in docs.columns])).rowsBetween(
        Window.unboundedPreceding, -1)
    again = again.withColumn(at, F.coalesce(F.sum(n).over(order), F.lit(0)))
    share = lambda x: F.floor(x * F.col(copies) / F.col(m))
    again = again.withColumn(k, share(F.col(at) + F.col(n)) - share(F.col(at))).where(F.col(k) > 0)
    return out.unionByName(again.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(k)))).select(
        *[f"`{c}`" for c in docs.columns]))
