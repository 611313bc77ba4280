"""Helpers shared by the operators: Arrow batches of bounded size and text columns as byte arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space; ``bytes.split()`` separates at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def utf8(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes uint8, offsets int64 of length rows + 1); null is empty."""
    col = batch.column(column)
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes of text each (a longer single text stands alone)."""
    off = utf8(batch, column)[1]
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(off, off[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def map_slices(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               most: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` in slices of bounded text, so a task's memory doesn't follow its partition's size."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, column, most):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def unused(columns: list[str]) -> str:
    """A prefix that none of the columns begins with, for names beside them."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def whole_row(df: DataFrame, *named: tuple[str, str]) -> DataFrame:
    """All columns packed in ``row`` beside copies of the named ones, so that added columns can't clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[F.col(f"`{c}`").alias(alias) for c, alias in named])


def map_groups(df: DataFrame, group: str, fn: Callable[[pa.Table], pa.Table | None], schema: str,
               gather: int = 0, parts: int = 0) -> DataFrame:
    """``fn`` over the rows of each value of ``group``, whose groups are bounded by construction.

    Rows are dealt out by the value (with ``parts``, to so many tasks) and sorted in their partition; a task holds one
    group at a time (with ``gather``, whole groups until they have so many bytes), so many tiny groups cost little and a
    partition may be of any size."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        last, size = None, 0

        def flush():
            out = fn(pa.Table.from_batches(held))
            if out is not None:
                yield from (x for x in out.to_batches() if x.num_rows)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and keys[a] != last and size >= gather:
                    yield from flush()
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                last = keys[a]
                size += part.nbytes if gather else 0
        if held:
            yield from flush()

    dealt = df.repartition(parts, group) if parts else df.repartition(group)
    return dealt.sortWithinPartitions(group).mapInArrow(run, schema)


def pair_blocks(df: DataFrame, group: str, size: str, member: str, most: int) -> DataFrame:
    """Rows of groups of any size (``size``: rows of the row's group) as groups of bounded size: a group beyond
    ``most`` rows is cut in blocks, and each pair of blocks (each block with itself, too) is a group of its own.  Adds
    ``g`` (the new group), ``block`` and ``within`` (whether the group is a block with itself)."""
    n = F.ceil(F.col(size) / most).cast("int")
    own = F.pmod(F.xxhash64(member, group), n).cast("int")
    one = df.withColumn("blocks", n).withColumn("block", F.when(F.col("blocks") > 1, own).otherwise(F.lit(0)))
    each = one.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return each.withColumn("g", F.xxhash64(F.lit("pairs"), F.col(group), low, high)).withColumn(
        "within", low == high).drop("blocks", "other")
