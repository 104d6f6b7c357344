"""How growing export files are shared among tasks."""

from ferrylog.sources import growing
from ferrylog.sources.growing import GrowingReader
from tests.test_growing import statements


def test_small_ranges_share_tasks(tmp_path, monkeypatch):
    """Tasks do not grow in number with the ranges; what is read is the same, span by span."""
    head, entries = statements(200)
    (tmp_path / "a.sql").write_text(head + "".join(entries[:120]))
    (tmp_path / "b.sql").write_text(head + "".join(entries[120:]))

    def read(reader):
        tasks = reader.partitions(reader.initialOffset(), reader.latestOffset())
        return len(tasks), sorted(tuple(r.values()) for t in tasks for b in reader.read(t) for r in b.to_pylist())

    few, rows = read(GrowingReader(str(tmp_path), "*.sql", 200))
    assert few == 1 and len({r[2] for r in rows}) > 50 and len(rows) == 202
    some, same = read(GrowingReader(str(tmp_path), "*.sql", 200, tasks=6))
    assert 6 <= some <= 8 and same == rows
    monkeypatch.setattr(growing, "TASK_BYTES", 0)
    many, same = read(GrowingReader(str(tmp_path), "*.sql", 200))
    assert many > 100 and same == rows
