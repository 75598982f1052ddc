"""Shards of tables in which every text has a copy: documents change places."""

from __future__ import annotations

import random
from collections import defaultdict

from tallyshelf.llm import sharding

from .fixtures import docs
from .test_simhash_sharding import check_shards


def test_pairs_only_are_kept_together(spark):
    rows = [(1000 * k + i, f"text {i}") for k in range(2) for i in range(207)] + [(5000, "last"), (5001, "last")]
    found = sharding.balanced_shards(docs(spark, rows), 16).collect()
    check_shards(rows, found, 16)
    held = defaultdict(set)
    for r in found:
        held[bytes(r.digest)].add(r.shard)
    assert sum(len(s) > 1 for s in held.values()) <= 10


def test_quotas_are_the_most():
    # A cycle stays whole; what has no way back goes.
    wanted = {(0, 1): 5, (1, 2): 5, (2, 0): 5, (3, 0): 5}
    assert sharding._quotas(wanted, [0] * 4) == {(0, 1): 5, (1, 2): 5, (2, 0): 5, (3, 0): 0}
    assert sharding._quotas({(0, 1): 7, (1, 0): 4}, [0, 2]) == {(0, 1): 6, (1, 0): 4}
    rng = random.Random(3)
    for _ in range(50):
        room = [rng.randint(0, 3) for _ in range(6)]
        wanted = {(a, b): rng.randint(0, 1000) for a in range(6) for b in range(6) if a != b}
        allowed = sharding._quotas(wanted, room)
        net = [sum(n for (_, b), n in allowed.items() if b == s) - sum(n for (a, _), n in allowed.items() if a == s) for s in range(6)]
        assert all(0 <= allowed[k] <= wanted[k] for k in wanted) and all(x <= y for x, y in zip(net, room))
