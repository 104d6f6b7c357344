"""Events of growing export files that go on in the next file."""

import pytest

from tests.test_growing import drain, parts


@pytest.mark.parametrize("gtids", ["11", "12"])
def test_an_event_goes_on_in_the_next_file(spark, tmp_path, gtids):
    """Its first part was the end of the drain before, whichever transaction the checkpoint names."""
    applied, job = parts(spark, tmp_path)
    folder = tmp_path / "export"
    folder.mkdir()
    (folder / "a.sql").write_text(f"[POSITION] b:5\n[GTID] u:{gtids}\nINSERT INTO db.t (k, v) VALUES (1, 'a');\n\n")
    drain(spark, tmp_path, job)
    (folder / "b.sql").write_text("-- head\n[POSITION] b:5\n[GTID] u:12\nUPDATE db.t SET k = 1, v = 'b' WHERE k = 1 AND v = 'a';\n\n"
                                  "[POSITION] b:6\n[GTID] u:13\nINSERT INTO db.t (k, v) VALUES (2, 'c');\n\n")
    drain(spark, tmp_path, job)
    assert sorted(map(tuple, applied.read().collect())) == [(1, "b"), (2, "c")]
