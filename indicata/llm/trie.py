"""Similarity join of sets of word n-grams over a prefix tree.

A document's set are its distinct five-word shingles; equal sets are one class.  To bring classes together without
comparing all, sets are read in one global order: a fixed slice of the hash space, rarest shingles first, then the
rest by hash.  A class with more unique shingles in the slice than a partner could lack is done; of the others, the
first n // 5 + 1 shingles go into lists, and two similar sets are sure to share one of these.  Classes that a list joins,
as far as sizes and places in the order allow an overlap that large, are families.  Within a family the ordered sets are stored in a trie; each set walks down it, so that common beginnings
are counted once for all sets below, and subtrees whose remaining lengths can't reach the overlap any more are pruned.
What the walk ends with are whole overlaps, so links are exact and each pair is counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import graph
from indicata.llm.common import map_groups, map_slices, pair_blocks, utf8
from indicata.llm.minhash import oracle as groups_oracle
from indicata.llm.minhash import shingle_sets, signature
from indicata.sinks.files import materialize

PERCENT = 80
#: The slice of the hash space whose shingles are counted over all documents: similar sets have a fifth of their
#: shingles apart at most, so a slice above that leaves room for unique ones.
SLICE_LIMIT = 1 << 62
#: Documents from which on a shingle counts as frequent, whatever their number.
FREQUENT = 4096
#: Sets of a family that meet at once, and shingles that a block of them may hold on average.
IN_FAMILY, SHINGLES_IN_FAMILY = 512, 1 << 19
#: Shingles of a trie node at most, so that long unshared ends can be left early.
PIECE = 64
#: Up to so many classes in families (a few bytes each) are sent to the scan of the texts; beyond, texts shuffle.
SENT = 200_000


def may_lack(n: np.ndarray | int, percent: int):
    """How many of its ``n`` shingles a set may have that a similar one lacks."""
    return n - -(-n * percent // 100)


def described(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, sig, n, inside, listed`` of ``docs(doc_id, text)``: signature (null if empty) and size of the set, how
    many shingles lie in the slice, and these, followed by as many others as the list may need."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, before = shingle_sets(batch)
        each = [values[a:b] for a, b in zip(before, before[1:])]
        inside = [int(np.searchsorted(x, np.uint64(SLICE_LIMIT))) for x in each]
        size = [max(i, min(len(x), int(may_lack(len(x), percent)) + 1)) for x, i in zip(each, inside)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([signature(x) for x in each], pa.binary()), pa.array(np.diff(before)),
             pa.array(inside, pa.int64()), pa.array([x[:s].tobytes() for x, s in zip(each, size)], pa.binary())],
            ["doc_id", "sig", "n", "inside", "listed"])

    return map_slices(docs, "text", run, f"doc_id {kind}, sig binary, n bigint, inside bigint, listed binary")


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of a stream sorted by the first one, cut where its value changes, as far as batches allow; with whether
    the last value may go on in what follows."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held, True
            held = [batch.column(c).to_numpy() for c in names]
    if held is not None:
        yield held, False


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``s, t, level`` for shingles of several classes, from pairs sorted by (t, s): level grows with the logarithm of
    their number; from FREQUENT on it is the same for all, so a run is never held beyond that."""
    top = int(FREQUENT).bit_length()
    kept = [np.empty(0, np.int64)] * 2
    over: int | None = None   # the shingle that already reached FREQUENT
    for (t, s), more in _runs(batches, ["t", "s"]):
        t, s = np.concatenate([kept[0], t]), np.concatenate([kept[1], s])
        starts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1])
        counts = np.diff(np.append(starts, len(t)))
        level = np.floor(np.log2(np.minimum(counts, FREQUENT) + 0.5)).astype(np.int32)
        level[counts >= FREQUENT] = top
        if over is not None and t[0] == over:
            level[0] = top
        done = len(t)
        if more and level[-1] < top:   # an unfinished run waits
            done = starts[-1]
        over = int(t[-1]) if more and level[-1] == top else None
        kept = [t[done:], s[done:]]
        each = np.repeat(level, counts)[:done]
        some = each > 0
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array(s[:done][some]), pa.array(t[:done][some]),
                                              pa.array(each[some])], ["s", "t", "level"])


def _listed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``t, n, reach, s``: the first shared shingles of each class, from rows sorted by (s, outside, level, t).

        If a shingle is the first that two sets have in common, their overlap is at most what either has from there
        on; ``reach`` is the size up to which a partner can be similar then."""
        def cut(own: list[np.ndarray]) -> pa.RecordBatch | None:
            s, t, outside, n, inside = own
            starts = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
            counts = np.diff(np.append(starts, len(s)))
            lack = may_lack(n[starts], percent)
            unique = inside[starts] - np.add.reduceat((~outside).astype(np.int64), starts)
            most = np.where(unique > lack, 0, lack + 1 - unique)
            place = np.arange(len(s)) - np.repeat(starts, counts)
            keep = np.flatnonzero(place < np.repeat(most, counts))
            if not len(keep):
                return None
            rest = n[keep] - np.repeat(unique, counts)[keep] - place[keep]   # itself and all that follow
            reach = rest * (100 + percent) // percent - n[keep]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (t[keep], n[keep], reach, s[keep])],
                                              ["t", "n", "reach", "s"])

        names = ["s", "t", "outside", "n", "inside"]
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            last = int(np.searchsorted(held[0] == held[0][-1], True))   # the last class may go on
            out = cut([x[:last] for x in held]) if last else None
            held = [x[last:] for x in held]
            if out is not None:
                yield out
        out = cut(held) if held is not None else None
        if out is not None:
            yield out

    return run


def _joined_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b``: for lists sorted by (t, n, s), links that connect whatever members could be similar: x and y with
    n_y <= reach_x and n_x <= reach_y.

    Members with reach >= n are intervals, and one is joined to the furthest reaching before it, if that reaches it.
    The others can only be the larger of a pair; all that they could go with reach beyond them, so one link does.
    Only the furthest reaching of an unfinished list are held."""
    none = np.empty(0, np.int64)
    last, records = None, (none, none, none)
    for batch in batches:
        if not batch.num_rows:
            continue
        t, n, reach, s = (batch.column(c).to_numpy() for c in ("t", "n", "reach", "s"))
        run = np.cumsum(np.concatenate([[last is not None and t[0] != last], t[1:] != t[:-1]]))
        if last is None or run[0]:
            records = (none, none, none)
        apart = 2 * int(max(n.max(), reach.max(), records[1].max(initial=0))) + 2   # lists side by side, out of reach
        at, far = n + run * apart, reach + run * apart
        wide = reach >= n
        own_at = np.concatenate([records[0] + run[0] * apart, at[wide]])
        own_far = np.concatenate([records[1] + run[0] * apart, far[wide]])
        own_s = np.concatenate([records[2], s[wide]])
        a, b = none, none
        if len(own_at):
            most = np.maximum.accumulate(own_far)
            new = np.concatenate([[True], own_far[1:] > most[:-1]])
            best = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            hit = np.flatnonzero(most[:-1] >= own_at[1:]) + 1
            hit = hit[hit >= len(records[0])]
            before = np.searchsorted(own_at, far[~wide], "right") - 1
            some = (before >= 0) & (most[np.maximum(before, 0)] >= at[~wide])
            a = np.concatenate([own_s[best[hit - 1]], own_s[best[before[some]]]])
            b = np.concatenate([own_s[hit], s[~wide][some]])
            kept = np.flatnonzero(new & (own_far >= at[-1]))
            records = (own_at[kept] - run[-1] * apart, own_far[kept] - run[-1] * apart, own_s[kept])
        last = t[-1]
        edges = np.unique(np.column_stack([a, b])[a != b], axis=0)
        if len(edges):
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])


def families(classes: DataFrame, percent: int) -> DataFrame:
    """``node, component``: classes (``s``) that may be similar to others of the same component only."""
    def pairs(batches):
        for batch in batches:
            raw, off = utf8(batch, "listed")
            s = np.repeat(batch.column("s").to_numpy(), np.diff(off) // 8)
            yield pa.RecordBatch.from_arrays([pa.array(raw.view(np.int64)), pa.array(s)], ["t", "s"])

    spread = classes.select("s", "listed").mapInArrow(pairs, "t bigint, s bigint")
    shared = spread.repartition("t").sortWithinPartitions("t", "s").mapInArrow(_shared, "s bigint, t bigint, level int")
    # hashes are unsigned: those at or above the limit, or negative as signed numbers, lie outside the slice
    outside = (F.col("t") < 0) | (F.col("t") >= SLICE_LIMIT)
    own = shared.join(classes.select("s", "n", "inside"), "s").withColumn("outside", outside)
    rows = own.repartition("s").sortWithinPartitions("s", "outside", "level", "t").select(
        "s", "t", "outside", "n", "inside").mapInArrow(_listed(percent), "t bigint, n bigint, reach bigint, s bigint")
    met = rows.repartition("t").sortWithinPartitions("t", "n", "s").mapInArrow(_joined_lists, "a bigint, b bigint")
    return graph.components(met.distinct())


class Trie:
    """Sets of numbers in one order (given as ascending arrays) in a tree whose nodes hold up to PIECE of them.

    Nodes are numbered level by level, the children of a node side by side."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        rows = [sets[i] for i in order]
        sizes = np.array([len(x) for x in rows])
        common = np.zeros(len(rows) + 1, np.int64)
        for i in range(1, len(rows)):
            n = min(sizes[i], sizes[i - 1])
            unlike = np.flatnonzero(rows[i][:n] != rows[i - 1][:n])
            common[i] = unlike[0] if len(unlike) else n
        self.none = 1 + max((int(x[-1]) for x in rows if len(x)), default=0)
        tokens, self.ends, lows, highs, self.child, self.children = [], [], [], [], [], []
        self.home = np.full(len(sets), -1, np.int64)
        queue = [(0, len(rows), 0)]   # rows low..high agree in their first `depth` numbers
        self.roots = 0
        for turn, (low, high, depth) in enumerate(self._grow(queue)):
            if turn:
                shared = int(common[low + 1:high].min()) if high - low > 1 else int(sizes[low])
                end = min(shared, depth + PIECE)
                piece = np.full(PIECE, self.none, np.int32)
                piece[:end - depth] = rows[low][depth:end]
                tokens.append(piece)
                self.ends.append(end)
                lows.append(int(sizes[low:high].min()))
                highs.append(int(sizes[low:high].max()))
            else:
                end = 0
            first = len(queue)
            at = low
            if turn and sizes[low] == end:   # sets are distinct: only the first can end here
                self.home[order[low]] = turn - 1
                at += 1
            if at < high:
                cuts = [at, *(at + 1 + np.flatnonzero(common[at + 1:high] <= end)).tolist(), high]
                queue.extend((a, b, end) for a, b in zip(cuts, cuts[1:]))
            if turn:
                self.child.append(first - 1)
                self.children.append(len(queue) - first)
            else:
                self.roots = len(queue) - first
        self.tokens = np.array(tokens, np.int32).reshape(-1, PIECE)
        self.ends, self.lows, self.highs, self.child, self.children = (
            np.array(x, np.int64) for x in (self.ends, lows, highs, self.child, self.children))
        self.lasts = np.array([int(x[x != self.none][-1]) for x in self.tokens], np.int64)

    @staticmethod
    def _grow(queue: list) -> Iterator[tuple[int, int, int]]:
        at = 0
        while at < len(queue):
            yield queue[at]
            at += 1

    def overlaps(self, one: np.ndarray, percent: int, mark: np.ndarray) -> np.ndarray:
        """Overlap of ``one`` with each stored set, or -1 where the walk was pruned.  ``mark`` (all false, one place
        for each number and ``none``) is left as it came."""
        n = len(one)
        mark[one] = True
        found = np.full(len(self.ends), -1, np.int64)
        nodes, above = np.arange(self.roots), np.zeros(self.roots, np.int64)
        while len(nodes):
            reach = (100 * self.highs[nodes] >= percent * n) & (percent * self.lows[nodes] <= 100 * n)
            nodes, above = nodes[reach], above[reach]
            if not len(nodes):
                break
            now = above + mark[self.tokens[nodes]].sum(axis=1)
            found[nodes] = now
            after = n - np.searchsorted(one, self.lasts[nodes], "right")
            best = now + np.minimum(self.highs[nodes] - self.ends[nodes], after)
            least = np.maximum(self.lows[nodes], -(-n * percent // 100))
            go = best * (100 + percent) >= percent * (n + least)
            nodes, now = nodes[go], now[go]
            counts = self.children[nodes]
            total = int(counts.sum())
            nodes = np.repeat(self.child[nodes] - np.cumsum(counts) + counts, counts) + np.arange(total)
            above = np.repeat(now, counts)
        mark[one] = False
        return np.where(self.home >= 0, found[self.home], 0)


def joined(percent: int):
    def run(group: pa.Table) -> pa.Table | None:
        """Spanning links ``x, y`` and, with y null, ``links`` of x, of the sets that meet.  Some whole groups may come
        at once; only sets of the same group meet, those of pairs of blocks only across."""
        name, s = group.column("g").to_numpy(), group.column("s").to_numpy()
        block, within = group.column("block").to_numpy(), group.column("within").to_numpy()
        _, first = np.unique(np.column_stack([name, s]), axis=0, return_index=True)
        name, s, block, within = name[first], s[first], block[first], within[first]
        if len(s) < 2:
            return None
        copies = group.column("copies").to_numpy()[first]
        raw = group.column("values").to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in first.tolist()]
        value, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(value), np.int64)   # frequent ones first: beginnings are shared by many
        rank[np.lexsort((value, -counts))] = np.arange(len(value))
        ends = np.cumsum([len(x) for x in sets])
        ordered = [np.sort(x) for x in np.split(rank[at], ends[:-1])]
        sizes = np.diff(np.concatenate([[0], ends]))
        # the same set may come in several groups: it is stored once
        distinct, stored = np.unique(s, return_inverse=True)
        some = np.empty(len(distinct), np.int64)
        some[stored] = np.arange(len(s))
        tree = Trie([ordered[i] for i in some.tolist()])
        mark = np.zeros(max(tree.none, len(value)) + 1, bool)
        label = np.arange(len(s))
        links, edges = np.zeros(len(s), np.int64), []
        got = [tree.overlaps(ordered[i], percent, mark) for i in some.tolist()] if len(distinct) < len(s) else None
        for i in range(len(s)):
            overlap = (got[stored[i]] if got else tree.overlaps(ordered[i], percent, mark))[stored]
            hit = (overlap >= 0) & (100 * overlap >= percent * (sizes + sizes[i] - overlap))
            hit &= (name == name[i]) & (within | (block != block[i]))
            hit[i] = False
            partners = np.flatnonzero(hit)
            links[i] = copies[partners].sum()
            for other in np.unique(label[partners]).tolist():
                if other != label[i]:
                    edges.append((s[i], s[partners[label[partners] == other][0]]))
                    label[label == other] = label[i]
        some = np.flatnonzero(links)
        if not len(some):
            return None
        x = [a for a, _ in edges] + s[some].tolist()
        y = [b for _, b in edges] + [None] * len(some)
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()),
                         "links": pa.array([0] * len(edges) + links[some].tolist(), pa.int64())})

    return run


def links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """What ``joined`` finds in the families of ``classes`` (``s, sig, doc_id, n, copies``); texts are read again for
    their members only, and their sets are shuffled, not the texts."""
    own = families(classes, percent)
    own = own.join(classes.select(F.col("s").alias("node"), "s", "sig", "doc_id", "n", "copies"), "node")
    size = own.groupBy("component").agg(
        F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") * IN_FAMILY / SHINGLES_IN_FAMILY)).alias("size"))
    wanted = materialize(own.join(size, "component").select("doc_id", "s", "sig", "component", "size", "copies"),
                         "trie-families")
    if wanted.count() <= SENT:
        wanted = F.broadcast(wanted)
    rows = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select(
        docs["text"], "s", "sig", "component", "size", "copies")

    def gathered(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        """Sets of the rows whose text has the wanted signature: ids may repeat, with other texts or not."""
        values, before = shingle_sets(batch)
        sets = [values[a:b] for a, b in zip(before, before[1:])]
        keep = [i for i, sig in enumerate(batch.column("sig").to_pylist()) if signature(sets[i]) == sig]
        if not keep:
            return None
        at = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(at) for c in ("s", "component", "size", "copies")),
             pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["s", "component", "size", "copies", "values"])

    sets = map_slices(rows, "text", gathered, "s bigint, component bigint, size bigint, copies bigint, values binary")
    members = pair_blocks(sets, "component", "size", "s", IN_FAMILY)
    return map_groups(members.select("g", "block", "within", "s", "copies", "values"), "g", joined(percent),
                      "x bigint, y bigint, links bigint", gather=1 << 18)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    Two documents link if ``100 * common >= percent * union`` of their sets; ``component_id`` is the smallest doc_id
    that links reach, ``n_links`` the number of other documents (rows) that a document links with, exact copies
    included.  Null, empty and wordless texts have an empty set and no links.  Rows that repeat an id are documents of
    their own.  A null id is the smallest of a group only if there are no others.  An empty table gives no rows.
    64-bit hashes stand for shingles, 128 bits for whole sets.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    seen = materialize(described(rows, percent), "trie-sets")
    classes = materialize(seen.where(F.col("sig").isNotNull()).groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("n", "inside", "listed")]).withColumn("s", F.xxhash64("sig")), "trie-classes")
    found = materialize(links(rows, classes, percent), "trie-links")
    linked = graph.components(found.where("y IS NOT NULL").select("x", "y"), "x", "y")
    linked = linked.join(classes.select(F.col("s").alias("node"), "doc_id"), "node")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    counted = found.where("y IS NULL").groupBy(F.col("x").alias("s")).agg(F.sum("links").alias("links"))
    groups = linked.join(least, "component").select(F.col("node").alias("s"), "component_id")
    told = classes.select("s", "sig", "doc_id", "copies").join(groups, "s", "left").join(counted, "s", "left").select(
        "sig", F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = seen.select("doc_id", "sig", F.col("n").alias("n_shingles")).join(told, "sig", "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def oracle(percent: int = PERCENT) -> str:
    """The same of ``documents`` in SQL: all pairs with a common shingle, and what links reach."""
    groups = groups_oracle(percent)
    last = groups.rindex("SELECT n.doc_id")
    return groups[:last] + """SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id,
           (SELECT count(*) FROM g WHERE g.a = n.doc_id)::BIGINT AS n_links
    FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n"""
