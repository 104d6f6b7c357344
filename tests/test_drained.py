"""Checks that drain the feed through handlers do not pass a failure off as a result."""

import pytest

from checks.jobs import e4_stream
from ferrylog.sinks.applied import AppliedTable


def test_a_failed_handler_is_no_result(spark, sf_dir, monkeypatch):
    """The target is away in the second micro-batch only."""
    apply, seen = AppliedTable.apply, []

    def away(self, changes, batch, *rest):
        seen.append(batch)
        if batch == "s-1":
            raise OSError("target went away")
        apply(self, changes, batch, *rest)

    monkeypatch.setattr(AppliedTable, "apply", away)
    with pytest.raises(RuntimeError, match="handler apply failed in batch 1: .*target went away"):
        e4_stream(spark, sf_dir)
    assert seen == ["s-0", "s-1"]
