"""Records of delimited text with quoted line breaks, one file over many tasks.

Where a record ends depends on whether a line starts inside a quoted field,
which depends on everything before it.  A block of a file (what one scan task
reads) turns "starts outside" and "starts inside" into an end each, whatever
comes before; the blocks of a file are then composed in order, which tells how
each one really starts.  A second pass cuts the blocks at record ends; only
what a block's ends leave over is put together with its neighbours'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicata.sinks.files import materialize

#: Blocks that start inside a quoted field, sent to the tasks by name (100 bytes or so each); beyond, a file is a task.
MOST_INSIDE = 50_000


def open_after(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted field is open at the end of a line.  A quote opens a
    field only at its first place; a doubled one stands for itself."""
    at = 0
    while True:
        if not inside:
            if line[at:at + 1] != '"':
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            inside, at = True, at + 1
        at = line.find('"', at) + 1
        if not at:
            return True
        if line[at:at + 1] == '"':
            at += 1
            continue
        inside = False
        at = line.find(sep, at) + 1   # whatever follows the closing quote belongs to the field
        if not at:
            return False


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Lines of one block at a time (a block may come in several pieces)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        start = batch.column("start").to_numpy()
        file = batch.column("file").dictionary_encode()
        code = file.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((start[1:] != start[:-1]) | (code[1:] != code[:-1])) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            yield file.dictionary[int(code[a])].as_py(), int(start[a]), batch.column("value").slice(a, b - a)


def _ends(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block, whether a field is open at its end if it starts outside, and if it starts inside."""
        found: dict[tuple[str, int], list[bool]] = {}
        for file, start, lines in _parts(batches):
            state = found.setdefault((file, start), [False, True])
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                state[:] = [open_after(line, x, sep) for x in state]
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "start": s, "outside": a, "inside": b} for (f, s), (a, b) in found.items()],
            schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()),
                              ("inside", pa.bool_())]))

    return run


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that start inside a field, from the blocks of whole files in order."""
    last, state = None, False
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            if x["file"] != last:
                last, state = x["file"], False
            if state:
                rows.append({"file": last, "start": x["start"]})
            state = x["inside"] if state else x["outside"]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("start", pa.int64())]))


_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("nth", pa.int64()),
                     ("text", pa.string())])
#: A whole record; what goes before a block's first record end, closing the record or not; what goes after its last.
WHOLE, CLOSING, WITHIN, OPENING = range(4)


def _cut(sep: str, inside: set[tuple[str, int]], whole: bool):
    """Pieces of the blocks, as many rows at once as come in; only whole records, or only what blocks leave over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, is_open, began, nth = None, [], False, False, 0
        found: list[tuple[int, int, str]] = []

        def pieces() -> Iterator[pa.RecordBatch]:
            if found:
                kind, order, texts = zip(*found)
                n = len(found)
                found.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(name[0], pa.string()), n), pa.repeat(pa.scalar(name[1], pa.int64()), n),
                     pa.array(kind, pa.int32()), pa.array(order, pa.int64()), pa.array(texts, pa.string())],
                    schema=_PIECES)

        def left() -> Iterator[pa.RecordBatch]:
            if held and not whole:
                found.append((OPENING if began else WITHIN, nth, "\n".join(held)))
            yield from pieces()

        for file, start, lines in _parts(batches):
            if (file, start) != name:
                yield from left()
                name, held, nth = (file, start), [], 0
                is_open = name in inside
                began = not is_open   # whether a record has begun in this block
            quoted = pc.match_substring(lines, '"').to_pylist()
            for line, quotes in zip(lines.to_pylist(), quoted):
                if not quotes:   # a whole record outside of a field, text inside one
                    if is_open:
                        held.append(line)
                        continue
                    if whole:
                        found.append((WHOLE, nth, line))
                    nth += 1
                    continue
                held.append(line)
                is_open = open_after(line, is_open, sep)
                if not is_open:
                    if began == whole:
                        found.append((WHOLE if began else CLOSING, nth, "\n".join(held)))
                    held, began, nth = [], True, nth + 1
            yield from pieces()
        if name is not None:
            yield from left()

    return run


def records(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame | None:
    """``record, _source_path, first, open`` of UTF-8 files: records as landed
    (line breaks inside quotes included, the one at the end not), whether a
    record is its file's first, and whether its last field never closes.  Empty
    lines between records are left out.  None if more blocks than can be sent
    to tasks start inside a field."""
    lines = _lines(spark, path)
    ends = lines.mapInArrow(_ends(sep), "file string, start bigint, outside boolean, inside boolean")
    inside = materialize(ends.repartition("file").sortWithinPartitions("file", "start").mapInArrow(
        _composed, "file string, start bigint"), "csv_blocks")
    if inside.count() > MOST_INSIDE:
        return None
    known = {(r.file, r.start) for r in inside.collect()}
    kinds = "file string, start bigint, kind int, nth bigint, text string"
    whole = lines.mapInArrow(_cut(sep, known, True), kinds).select(
        "text", "file", (F.col("start") + F.col("nth") == 0).alias("first"), F.lit(False).alias("open"))
    # what the blocks' ends left over, a few pieces of each block at most; a record begins with an opening piece
    rest = lines.mapInArrow(_cut(sep, known, False), kinds)
    order = Window.partitionBy("file").orderBy("start", "nth")
    rest = rest.withColumn("record", F.sum((F.col("kind") == OPENING).cast("int")).over(order))
    joined = rest.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("start", "nth", "text"))).alias("pieces"),
        F.min(F.struct("start", "nth")).alias("begin"), (~F.bool_or(F.col("kind") == CLOSING)).alias("open"))
    joined = joined.select(F.array_join("pieces.text", "\n").alias("text"), "file",
                           ((F.col("begin.start") == 0) & (F.col("begin.nth") == 0)).alias("first"), "open")
    text = F.regexp_replace("text", r"\r$", "")
    return whole.unionByName(joined).select(text.alias("record"), F.col("file").alias("_source_path"), "first",
                                            "open").where(F.col("record") != "")
