import pyarrow as pa

from gleanstream.llm import tables


def test_memory_goes_back_after_each_batch(monkeypatch):
    """What a worker takes in one stage must not stay taken in all later ones."""
    calls = []
    monkeypatch.setattr(tables, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"n": list(range(size))}) for size in (5, 0, 3)]
    parts = list(tables.slices(iter(batches), 2))
    assert [part.column(0).to_pylist() for part in parts] == [[0, 1], [2, 3], [4], [0, 1], [2]]
    assert len(calls) == 3


def test_giving_back_keeps_what_is_in_use():
    column = pa.array(["a", None, "b" * 100_000])
    tables.give_back()
    assert column.to_pylist() == ["a", None, "b" * 100_000]
