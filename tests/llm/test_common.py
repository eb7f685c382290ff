"""What the operators share."""

import pyarrow as pa

from inkwell.llm import common


def test_slices_are_bounded_in_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(common, "ROWS", 4)
    monkeypatch.setattr(common, "BYTES", 10)
    values = ["a", None, "", "b" * 25, "c" * 6, "d" * 4, "e", *"fghijk", None, None, None, None, None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(values))), "text": values})
    parts = list(common.texts(iter([batch, batch.slice(3, 2), batch.slice(0, 0)])))
    assert [t for _, p in parts for t in p] == [v if v is None else v.encode() for v in values + values[3:5]]
    assert [n for b, _ in parts for n in b.column(0).to_pylist()] == [*range(len(values)), 3, 4]
    assert all(len(p) <= 4 and (len(p) == 1 or sum(len(t or b"") for t in p) <= 10) for _, p in parts)
