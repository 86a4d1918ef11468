"""Op 1's tasks hold little beside their entries and give memory back."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from catchment.llm import suffix_dedup as op


class Frame:
    """Stands for a frame; keeps what would run in its tasks."""

    def __init__(self):
        self.run = []

    def groupBy(self, name):
        return self

    def applyInArrow(self, function, schema):
        self.run.append(function)
        return self

    def mapInArrow(self, function, schema):
        self.run.append(function)
        return self


@pytest.fixture
def given(monkeypatch):
    times = []
    monkeypatch.setattr(op, "give_back", lambda: times.append(1))
    return times


def bucket_of(entries, width):
    return pa.Table.from_batches([batch for some in entries for batch in op.packed(some, 1, width)])


def kept(table, width):
    """(text, name or kind, flag) of all that is told."""
    found = []
    for row in table.to_pylist():
        owners = np.repeat(np.frombuffer(row["keys"], np.int64), np.frombuffer(row["counts"], np.uint32))
        found += zip(owners.tolist(), op.wide(row["names"], width).tolist(), list(row["flags"]), strict=True)
    return sorted(found)


def test_a_bucket_takes_little_memory_beside_its_entries(given):
    frame, draw, number = Frame(), np.random.default_rng(1), 400_000
    op.repeated(frame, 1, 5)
    names = draw.integers(0, 1 << 40, number, dtype=np.uint64)
    table = bucket_of([[op.Entry(key, part, np.zeros(0, np.uint64))] for key, part in enumerate(np.split(names, 100))], 5)
    tracemalloc.start()
    frame.run[0]((pa.scalar(0),), table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * number and given == [1]


def test_all_shares_of_a_bucket_are_told(given):
    frame = Frame()
    op.repeated(frame, 1, 5)
    none = np.zeros(0, np.uint64)
    table = bucket_of([[op.Entry(1, np.arange(0, 9, dtype=np.uint64), none)], [op.Entry(2, np.arange(4, 12, dtype=np.uint64), none)]], 5)
    told = frame.run[0]((pa.scalar(0),), table)
    assert kept(told, 5) == [(key, name, op.REPEATED) for key in (1, 2) for name in range(4, 9)]


def test_kinds_of_a_name_meet_in_one_share(given):
    frame = Frame()
    op.repeated(frame, 1, 8)
    names = np.array([5, 6, 7], np.uint64)
    table = bucket_of([[op.Entry(key, names, np.array(kinds, np.uint64))] for key, kinds in ((1, (50, 60, 70)), (2, (51, 60, 71)), (3, (51, 62, 70)))], 8)
    told = dict(((key, kind), flag) for key, kind, flag in kept(frame.run[0]((pa.scalar(0),), table), 8))
    sender, both = op.SENDER, op.SENDER | op.REPEATED
    assert told == {(1, 50): sender, (2, 51): both, (3, 51): 1, (1, 60): both, (2, 60): 1, (3, 62): sender, (1, 70): both, (3, 70): 1, (2, 71): sender}


def test_workers_give_memory_back_after_a_task(given):
    frame = Frame()
    op.first_names(frame, op.LENGTH, op.cover_for(op.LENGTH), 1, 5)
    batch = pa.RecordBatch.from_arrays([pa.array([b"some text " * 50, b""])], names=["_data"])
    assert sum(out.num_rows for out in frame.run[0](iter([batch, batch]))) > 0 and given == [1]


def test_large_batches_are_worked_on_in_parts():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * op.ROWS + 1))], names=["key"])
    parts = [*op.slices(iter([batch]))]
    assert [part.num_rows for part in parts] == [op.ROWS, op.ROWS, 1] and pa.Table.from_batches(parts).num_rows == batch.num_rows
