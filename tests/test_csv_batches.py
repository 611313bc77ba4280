"""Quoted records leave a task in batches as large as those that came in."""

import pyarrow as pa

from indicata.sources import csv_records


def block(lines, start=0):
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.array(lines), pa.array(["f"] * n), pa.array([start] * n, pa.int64())], ["value", "file", "start"])


def test_a_batch_of_quoted_records_is_one_batch():
    lines = [x for i in range(700) for x in (f'{i};"a', f'b";{i}')]
    found = list(csv_records._cut(";", set(), True)(iter([block(["k;v;w", *lines])])))
    assert len(found) == 1
    rows = found[0].to_pylist()
    assert [r["text"] for r in rows] == ["k;v;w", *(f'{i};"a\nb";{i}' for i in range(700))]
    assert [r["nth"] for r in rows] == list(range(701))
    assert not list(csv_records._cut(";", set(), False)(iter([block(["k;v;w", *lines])])))


def test_what_blocks_leave_over_comes_apart_from_whole_records():
    batches = [block(['k;"a', 'b";c', "x;y", 'm;"n']), block(['o', 'p";q', "r;s"], 50)]
    inside = {("f", 50)}
    whole = [r for b in csv_records._cut(";", inside, True)(iter(batches)) for r in b.to_pylist()]
    rest = [r for b in csv_records._cut(";", inside, False)(iter(batches)) for r in b.to_pylist()]
    assert [(r["start"], r["nth"], r["text"]) for r in whole] == [(0, 0, 'k;"a\nb";c'), (0, 1, "x;y"), (50, 1, "r;s")]
    assert [(r["start"], r["nth"], r["kind"], r["text"]) for r in rest] == [
        (0, 2, csv_records.OPENING, 'm;"n'), (50, 0, csv_records.CLOSING, 'o\np";q')]
