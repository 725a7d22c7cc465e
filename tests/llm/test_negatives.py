"""Hard negatives against comparing all pairs, and the pruning by coordinates."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import negatives

ROWS = "vec_id long, embedding array<double>, label int"


def all_pairs(rows, anchors, positives=5, most=5, low=80, high=100):
    def usable(r):
        return (
            r[0] is not None
            and r[1] is not None
            and r[2] is not None
            and all(x is not None and math.isfinite(x) for x in r[1])
        )

    def score(a, b):
        found = sum(
            math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False)
        )
        return max(-(2**63), min(2**63 - 1, found))

    rows, anchors = [r for r in rows if usable(r)], [r for r in anchors if usable(r)]
    out = []
    for a in {(i, tuple(v), label) for i, v, label in anchors}:
        found = sorted((-score(a[1], r[1]), r[0], r[2]) for r in rows if r[0] != a[0])
        near = [f for f in found if f[2] == a[2]][:positives]
        for p in near:
            fit = [n for n in found if n[2] != a[2] and low * -p[0] <= 100 * -n[0] <= high * -p[0]]
            out += [
                (a[0], p[1], rank, n[1], -p[0], -n[0]) for rank, n in enumerate(fit[:most], 1)
            ]
    return sorted(out)


def mined(spark, rows, anchors, **options):
    table = spark.createDataFrame(rows, ROWS).repartition(3)
    asked = spark.createDataFrame(anchors, ROWS)
    return sorted(map(tuple, negatives.hard_negatives(table, asked, **options).collect()))


def groups(rng, n, width):
    """Vectors around few centres, of different length, some of them equal."""
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        by = rng.choice([0.1, 1, 1, 5])
        row = [by * (x + rng.gauss(0, 0.3)) for x in rng.choice(centres)]
        if rows and rng.random() < 0.1:
            row = rng.choice(rows)[1]
        rows.append((i, row, rng.randint(0, 3)))
    return rows


@pytest.mark.parametrize("width", [1, 2, 7, 24])
def test_negatives_equal_all_pairs(spark, width):
    rng = random.Random(width)
    rows = groups(rng, 400, width)
    anchors = rows[::20]
    want = all_pairs(rows, anchors)
    assert mined(spark, rows, anchors) == want and len(want) > 50
    # Many blocks of anchors give the same.
    assert mined(spark, rows, anchors, block_bytes=8 * width * 4) == want
    wide = dict(positives=2, low=10, high=300)
    assert mined(spark, rows, anchors, negatives=9, **wide) == all_pairs(rows, anchors, most=9, **wide)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [0.5], 2), (1, [1.0, None], 1), (2, None, 1), (3, [nan, 1.0], 1)]
    rows += [(4, [inf, 0.0], 1), (5, [1.0, 2.0], 1), (6, [1.0, 1.9], 2), (6, [1.0, 1.9], 2), (7, [], 2)]
    rows += [(None, [1.0, 2.0], 2), (8, [1.0, 1.9], None), (0, [1.0, 2.0], 1), (9, [0.0, 0.0], 1)]
    rows += [(10, [-1.0, -2.0], 1), (11, [1.0, 2.0, 3.0], 2)]
    for own in (rows[:1], rows, rows[9:10], rows[1:2] * 2):
        assert mined(spark, rows, own) == all_pairs(rows, own)
    assert mined(spark, rows, []) == [] and mined(spark, [], rows) == []


def test_scores_that_need_more_than_doubles(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(0, 1e9), rng.uniform(-1e9, 1e9), 1.0], i % 2) for i in range(80)]
    assert mined(spark, rows, rows[:9]) == all_pairs(rows, rows[:9])
    huge = [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1), (3, [-1e30], 1)]
    assert mined(spark, huge, huge) == all_pairs(huge, huge)


def test_extra_columns(spark):
    rows = groups(random.Random(3), 60, 5)
    table = spark.createDataFrame(rows, ROWS)
    plain = sorted(map(tuple, negatives.hard_negatives(table, table.where("vec_id < 5")).collect()))
    for name in ("query", "rank", "score", "anchor_id", "positive_id"):
        table = table.withColumn(name, F.lit(name))
    found = negatives.hard_negatives(table, table.where("vec_id < 5")).collect()
    assert sorted(map(tuple, found)) == plain


def test_ranges_keep_every_member_and_leave_most_out():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    rows = np.floor(256 * (centres[rng.integers(0, 8, 3000)] + 0.2 * rng.normal(size=(3000, 12))))
    ids, labels = np.arange(3000), np.zeros(3000, np.int64)
    anchors = negatives.Anchors(ids[:40], labels[:40], rows[:40])
    exact = rows[:40] @ rows.T
    need = 0.8 * np.sort(exact, axis=1)[:, -6]
    looked, pairs = 0, set()
    for bucket in negatives.buckets(rows, ids, labels):
        for who, member in anchors.members(bucket, need):
            looked += len(who)
            pairs |= set(zip(who.tolist(), bucket.ids[member].tolist(), strict=True))
    wanted = {(int(a), int(b)) for a, b in np.argwhere(exact >= need[:, None])}
    assert wanted <= pairs and looked < 0.35 * exact.size
    lists = bucket.sorted_list(3)
    assert (np.diff(lists[1]) >= 0).all()


def test_products_stand_in_where_ranges_leave_most_members(monkeypatch):
    rng = np.random.default_rng(7)
    ids, labels = np.arange(2000), rng.integers(0, 6, 2000)

    def found(rows, own, best=60):
        anchors = negatives.Anchors(ids[:30], labels[:30], rows[:30])
        exact = rows[:30] @ rows.T
        need = np.sort(exact, axis=1)[:, -best]
        got = [
            (int(a), int(bucket.ids[m]), int(score))
            for bucket in negatives.buckets(rows, ids, labels)
            for part in anchors.reaching(bucket, need, own)
            for a, m, score in zip(*part, strict=True)
        ]
        wanted = {(a, m, int(exact[a, m])) for a, m in np.argwhere(exact >= need[:, None]).tolist()}
        if own:
            wanted = {(a, m, score) for a, m, score in wanted if labels[a] == labels[m]}
            assert all(labels[a] == labels[m] for a, m, _ in got)
        assert wanted <= set(got) and len(got) == len(set(got))
        return len(got), len(wanted)

    looked = []
    members = negatives.Anchors.members
    monkeypatch.setattr(negatives.Anchors, "members", lambda *args: looked.append(1) or members(*args))
    unit = rng.normal(size=(2000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    # Near random directions: nothing is looked up, and nothing else comes back. Large components need doubles.
    for scale in (256, 1e6):
        for own in (False, True):
            n, wanted = found(np.floor(scale * unit), own)
            assert n == wanted and not looked
    # Around few centres, ranges leave little.
    near = rng.normal(size=(200, 8))[rng.integers(0, 200, 2000)] + 0.001 * rng.normal(size=(2000, 8))
    near /= np.linalg.norm(near, axis=1)[:, None]
    found(np.floor(1e5 * near), True, 5)
    assert looked


def test_first_rows_of_a_task_come_a_few_at_a_time():
    rows = [{"vec_id": i, "embedding": [float(i)], "label": 0} for i in range(1000)]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 500]) for i in (0, 500)]
    sizes = [len(b.ids) for b in negatives._buckets_of(batches, 1)]
    assert sizes[0] <= negatives.FEWEST and sum(sizes) == 1000
    assert {i for b in negatives._buckets_of(batches, 1) for i in b.ids.tolist()} == set(range(1000))
