"""Updates that move keys, settled key by key before keys are tied."""

import random

import pytest

from ferrylog.operators import fold
from tests.model import apply_keyed
from tests.test_fold import key, random_log, random_rows, run


@pytest.mark.parametrize("rounds, tied, possible", [(6, 20, 16), (1, 1, 16), (6, 20, 1)])
def test_settled_moves(spark, monkeypatch, rounds, tied, possible):
    """All rounds, one round and then halves of what is left, and keys whose rows are not told apart."""
    for name, value in (("ROUNDS", rounds), ("TIED", tied), ("POSSIBLE", possible)):
        monkeypatch.setattr(fold, name, value)
    rnd = random.Random(rounds + tied)
    rows = random_rows(rnd, 60)
    log = random_log(rnd, rows, 60, 240, moves=0.4)
    assert run(spark, rows, log, ["k"], hot_limit=4) == apply_keyed(rows, log, key)


def test_moves_that_miss_tie_no_keys(spark, monkeypatch):
    """Every key would move to a lower one whose row is still there: one component of all keys, in which nothing lands."""
    def none(*args):
        raise AssertionError("keys were tied")

    monkeypatch.setattr(fold, "component_labels", none)
    rows = [(k, "x", k) for k in range(200)]
    log = [("UPDATE", (k, "x", k), (k // 2, "y", k)) for k in reversed(range(1, 200))]
    assert run(spark, rows, log, ["k"], hot_limit=100) == apply_keyed(rows, log, key) == sorted(rows, key=repr)
