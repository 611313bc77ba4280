"""Near duplicates by bottom-k sketches from one hash function.

A document's set are its distinct five-word shingles; its sketch the k smallest hashes of them.  Equal sets are one
class from the start.  Inverted lists of retained values bring candidate classes together: each class stands in the
lists of its rarest values only, as many as are needed so that two sketches with the overlap of near duplicates meet
(prefix filter).  Within a list the union sketch estimates the similarity; estimates that reach the filter join
classes to families, and within a family exact similarities of full sets, gathered through an inverted index of
shingles, make the links.  Lists and families beyond a block are cut into pairs of blocks, and only the links that
join something new are written, so groups of any size neither meet in one task nor turn into all their pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import graph, shingles
from indicata.llm.common import WORD, map_groups, map_slices, pair_blocks, unused, utf8, whole_row
from indicata.sinks.files import materialize

K = 32
#: Sketches of near duplicates share at least so many values: at similarity 0.85 fewer than 14 of 32 come about once
#: in ten million pairs.
SHARED = 14
PERCENT = 85
IN_LIST, IN_FAMILY = 2048, 512
#: Up to so many family members (a few bytes each) are sent to the scan of the texts; beyond, the texts are shuffled.
SENT = 200_000


def shingle_sets(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their number before each text."""
    hashes, _, _, before = shingles.words(*utf8(batch, column))
    return shingles.sets(*shingles.runs_of_words(hashes, before))


def signature(one: np.ndarray) -> bytes | None:
    """128 bits that stand for a whole set; none for an empty one."""
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """``doc_id, sig, n_shingles, sketch`` of every row: its set's signature (null if empty), size and k least
    hashes."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, before = shingle_sets(batch)
        each = [values[a:b] for a, b in zip(before, before[1:])]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([signature(x) for x in each], pa.binary()),
             pa.array(np.diff(before)), pa.array([x[:k].tobytes() for x in each], pa.binary())],
            ["doc_id", "sig", "n_shingles", "sketch"])

    return map_slices(rows, "text", run, f"doc_id {kind}, sig binary, n_shingles bigint, sketch binary")


def _spanning(n: int, near, sides: np.ndarray | None, lazy: bool = False) -> list[tuple[int, int]]:
    """Links (root, member) that join what ``near(i)`` (a mask over all) connects; with ``sides``, only across.
    ``lazy``: ``near`` is also told which are left, and needs to look at no others."""
    left = np.ones(n, bool)
    links = []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and left.any():
            i = queue.pop()
            open_ = left if sides is None else left & (sides != sides[i])
            hit = (near(i, open_) if lazy else near(i)) & open_
            found = np.flatnonzero(hit)
            left[found] = False
            queue.extend(found.tolist())
            links.extend((root, j) for j in found.tolist())
    return links


def _edges(sigs: list[bytes], links: list[tuple[int, int]]) -> pa.Table | None:
    if not links:
        return None
    return pa.table({"a": pa.array([sigs[i] for i, _ in links], pa.binary()),
                     "b": pa.array([sigs[j] for _, j in links], pa.binary())})


def _distinct(group: pa.Table) -> tuple[list[bytes], list[int], np.ndarray | None]:
    """Signatures, the first row of each, and their blocks (none within one block)."""
    first: dict[bytes, int] = {}
    for i, x in enumerate(group.column("sig").to_pylist()):
        first.setdefault(x, i)
    rows = list(first.values())
    blocks = group.column("block").to_numpy()[rows]
    return list(first), rows, None if group.column("within")[0].as_py() else blocks


def estimated(k: int, shared: int, percent: int):
    """Links of a list by the union sketch: the share of common values among the k least of both."""
    def run(group: pa.Table) -> pa.Table | None:
        sigs, rows, sides = _distinct(group)
        if len(sigs) < 2:
            return None
        sizes = group.column("n_shingles").to_numpy()[rows]
        sketch = group.column("sketch").to_pylist()
        lengths = np.array([len(sketch[i]) // 8 for i in rows])
        table = np.full((len(rows), k), np.iinfo(np.uint64).max, np.uint64)
        for i, row in enumerate(rows):
            table[i, :lengths[i]] = np.frombuffer(sketch[row], np.uint64)
        there = np.arange(k)[None, :] < lengths[:, None]

        def near(i: int) -> np.ndarray:
            own = table[i, :lengths[i]]
            below = np.searchsorted(own, table)
            common = there & (own[np.minimum(below, len(own) - 1)] == table)
            place = np.arange(k)[None, :] + below - (np.cumsum(common, axis=1) - common)
            union = np.minimum(k, lengths[i] + lengths - common.sum(axis=1))
            like = (common & (place < k)).sum(axis=1) * k >= shared * union
            return like & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))

        return _edges(sigs, _spanning(len(sigs), near, sides))

    return run


def exact(percent: int):
    """Links of a family by the full sets of its texts."""
    def run(group: pa.Table) -> pa.Table | None:
        sigs, rows, sides = _distinct(group)
        if len(sigs) < 2:
            return None
        texts = group.column("text").to_pylist()
        batch = pa.RecordBatch.from_arrays([pa.array([texts[i] for i in rows], pa.string())], ["text"])
        values, before = shingle_sets(batch)
        sizes = np.diff(before)
        # an inverted index: the holders of each shingle, in order of shingles
        term, at, counts = np.unique(values, return_inverse=True, return_counts=True)
        holders = np.repeat(np.arange(len(rows)), sizes)[np.argsort(at, kind="stable")]
        starts = np.cumsum(counts) - counts

        def near(i: int) -> np.ndarray:
            own = at[before[i]:before[i + 1]]
            own = own[counts[own] > 1]
            n = counts[own]
            reach = np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(holders[reach], minlength=len(rows))
            return 100 * common >= percent * (sizes + sizes[i] - common)

        return _edges(sigs, _spanning(len(sigs), near, sides))

    return run


def candidate_links(classes: DataFrame, k: int, shared: int, percent: int) -> DataFrame:
    """``a, b``: classes whose sketches meet in an inverted list and pass the estimate, as spanning links."""
    values = classes.select("sig", "n_shingles", F.size("values").alias("kept"), F.explode("values").alias("value"))
    common = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = values.join(common, "value").groupBy("sig", "n_shingles", "kept").agg(
        F.sort_array(F.collect_list(F.struct("n", "value"))).alias("held"))  # at most k values of a class
    least = F.least(F.lit(shared), F.ceil(F.col("n_shingles") * percent / 100))
    alone = F.col("kept") - F.size("held")  # rarer still: in no other sketch
    prefix = (F.col("kept") - least + 1 - alone).cast("int")
    listed = held.where(prefix > 0).select("sig", F.explode(F.slice("held", 1, prefix)).alias("x")).select(
        "sig", F.col("x.value").alias("value"))
    listed = materialize(listed, "sketch-lists")
    sizes = listed.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = listed.join(sizes, "value")
    # short lists with the same members are one list
    short = listed.where("n <= 16").groupBy("value").agg(F.sort_array(F.collect_list("sig")).alias("members"))
    short = short.groupBy("members").agg(F.min("value").alias("value")).select(
        "value", F.size("members").cast("bigint").alias("n"), F.explode("members").alias("sig"))
    lists = short.unionByName(listed.where("n > 16"))
    rows = pair_blocks(lists, "value", "n", "sig", IN_LIST).join(
        classes.select("sig", "n_shingles", "sketch"), "sig").select("g", "block", "within", "sig", "n_shingles",
                                                                     "sketch")
    return map_groups(rows, "g", estimated(k, shared, percent), "a binary, b binary")


def exact_links(docs: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """``a, b``: spanning links of the exact similarity within each family (``node, component, doc_id``)."""
    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    wanted = families.join(sizes, "component").select("doc_id", F.col("node").alias("sig"), "component", "n")
    if wanted.count() <= SENT:
        wanted = F.broadcast(wanted)
    rows = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select(
        docs["text"], "sig", "component", "n")

    def only_own(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Rows whose text has the wanted signature, each signature once: ids may repeat, with other texts or not."""
        values, before = shingle_sets(batch)
        seen, keep = set(), []
        for i, sig in enumerate(batch.column("sig").to_pylist()):
            if sig not in seen and signature(values[before[i]:before[i + 1]]) == sig:
                seen.add(sig)
                keep.append(i)
        return batch.take(pa.array(keep, pa.int64()))

    members = pair_blocks(map_slices(rows, "text", only_own, "text string, sig binary, component binary, n bigint"),
                          "component", "n", "sig", IN_FAMILY)
    return map_groups(members.select("g", "block", "within", "sig", "text"), "g", exact(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, shared: int = SHARED,
                    percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, sig, component`` of every row.

    Documents are linked if ``100 * common >= percent * union`` of their sets; ``component_id`` is the smallest
    doc_id that links reach, ``kept`` marks it; ``component`` is null without links to another set.  Null, empty and
    wordless texts have an empty set and no links.  Equal rows are linked, so all rows of a kept doc_id and set are
    marked kept (``sig`` tells equal sets).  A null id is the smallest of a group only if there are no others.  An
    empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    seen = materialize(sketches(rows, k=k), "sketches")
    classes = seen.where(F.col("sig").isNotNull()).groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"))
    classes = materialize(_with_values(classes), "sketch-classes")
    families = graph.components(candidate_links(classes, k, shared, percent))
    families = families.join(classes.select(F.col("sig").alias("node"), "doc_id"), "node")
    linked = graph.components(exact_links(rows, families, percent))
    linked = materialize(linked.join(classes.select(F.col("sig").alias("node"), "doc_id"), "node"), "near-links")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups = linked.join(least, "component").select(F.col("node").alias("sig"), "component", "component_id")
    alone = classes.join(groups, "sig", "left").select(
        "sig", "component", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = seen.drop("sketch").join(alone, "sig", "left")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "sig", "component")


def _with_values(classes: DataFrame) -> DataFrame:
    """Sketches also as arrays of numbers."""
    def run(batches):
        for batch in batches:
            raw, off = utf8(batch, "sketch")
            values = pa.ListArray.from_arrays(pa.array((off // 8).astype(np.int32)), pa.array(raw.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, "values"])
    kinds = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in classes.schema)
    return classes.mapInArrow(run, f"{kinds}, values array<bigint>")


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that ``found`` (their ``near_duplicates``) doesn't keep: one row of each
    group, and every row without words.

    Where ids repeat, rows are told apart by their sets; of the rows of a kept set and id, the least by hash stays.
    """
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("kept"))
    ids = materialize(ids.where("n > 1 OR NOT kept"), "near-dropped")
    own, own_id = F.col(f"`{key}`"), unused(docs.columns) + "id"

    def without(names: DataFrame, how: str) -> DataFrame:
        names = names.select(F.col("doc_id").alias(own_id))
        names = F.broadcast(names) if names.count() <= SENT else names
        return docs.join(names, own.eqNullSafe(F.col(own_id)), how)

    out = without(ids, "left_anti")
    if ids.where("n > 1").isEmpty():
        return out
    again = whole_row(without(ids.where("n > 1"), "left_semi"), (key, "doc_id"), (text, "text"))
    row = again.schema["row"].dataType.simpleString()

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, before = shingle_sets(batch)
        sigs = [signature(values[a:b]) for a, b in zip(before, before[1:])]
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(sigs, pa.binary())],
                                          ["row", "id", "sig"])

    signed = map_slices(again, "text", sign, f"row {row}, id {again.schema['doc_id'].dataType.simpleString()}, "
                        "sig binary")
    kept = found.where("kept").select("doc_id", F.col("sig").alias("kept_sig")).distinct()
    rows = signed.join(kept, signed["id"].eqNullSafe(kept["doc_id"]) & (signed["sig"] == kept["kept_sig"]))
    first = Window.partitionBy("sig").orderBy(F.xxhash64("row"))
    one = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
    return out.unionByName(one).unionByName(signed.where(F.col("sig").isNull()).select("row.*"))


def oracle(percent: int = PERCENT) -> str:
    """The same groups of ``documents`` in SQL: all pairs with a common shingle, and what links reach."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') AS ws
        FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
                 END AS xs FROM w),
    n AS (SELECT doc_id, len(xs)::BIGINT AS n FROM s),
    e AS (SELECT doc_id, unnest(xs) AS x FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
    g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT r.doc_id, g.b FROM r JOIN g ON g.a = r.m)
    SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id, n.doc_id = min(r.m) AS kept
    FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n"""
