import math
import random

import pytest
from pyspark.sql import functions as F

from orderloom.llm import curriculum as cu

from .frames import clashing, docs

KNOTS = ((0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 3.0))


def plain_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Reshare the excess round by round; sizes by source, in the order of the sources."""
    left, free = float(sum(sizes)), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while free:
        total = sum(weights[i % 3] for i in free)
        share = {i: left * weights[i % 3] / total for i in free}
        over = [i for i in free if share[i] >= repeats * sizes[i]]
        for i in over or free:
            out[i] = float(repeats * sizes[i]) if over else share[i]
        if not over:
            break
        left -= sum(repeats * sizes[i] for i in over)
        free = [i for i in free if i not in over]
    return out


def test_targets_equal_resharing_by_rounds(spark):
    pick = random.Random(2)
    for n in (1, 2, 7, 40):
        sizes = [pick.choice([0, 1, 10, 1000, 50_000]) * pick.randrange(1, 9) for _ in range(n)]
        names = [f"s{i:03}" for i in range(n - 1)] + [None]
        rows = [(str(i), s, z) for i, (s, z) in enumerate(zip(names, sizes, strict=True))]
        df = spark.createDataFrame(rows, "src string, source string, source_size long")
        got = {r.src: r.target for r in cu.targets(df).collect()}
        expected = plain_targets(sizes)
        assert [got[str(i)] for i in range(n)] == pytest.approx(expected, abs=1e-6)
        assert sum(got.values()) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("knots", [*cu.SCHEDULES, KNOTS])
def test_position_inverts_the_integral(spark, knots):
    def used(t):
        total = 0.0
        for (a, v), (b, w) in zip(knots, knots[1:]):
            x = min(max(t - a, 0.0), b - a)
            total += v * x + (w - v) / (b - a) * x * x / 2
        return total

    df = spark.range(1, 1000).select((F.col("id") / 1000).alias("share"))
    rows = df.select("share", cu.position_at(F.col("share"), knots).alias("at")).collect()
    assert all(math.isclose(used(r["at"]) / used(1.0), r.share, abs_tol=1e-9) for r in rows)


def test_taken_near_target_in_order_and_whole(spark):
    pick = random.Random(4)
    texts = [" ".join(["w"] * pick.randrange(1, 60)) for _ in range(600)]
    sources = [pick.choice("aaaaabc") for _ in texts]
    sources[:20] = [None] * 20
    df = clashing(docs(spark, texts, sources))
    plan = cu.schedule(df).collect()
    assert len(plan) == 600
    sizes = {i: len(t.split()) for i, t in enumerate(texts)}
    for r in plan:
        assert r.size == sizes[r.doc_id] and r.taken == len(r.positions) * r.size <= 3 * r.size
        assert r.positions == sorted(r.positions) and all(0 < p <= 1 for p in r.positions)
    by = {}
    for r in plan:
        by.setdefault(r.src, []).append(r)
    ordered = sorted(by, key=lambda s: (s == "", s))
    expected = plain_targets([by[s][0].source_size for s in ordered])
    for src, target in zip(ordered, expected, strict=True):
        rows = by[src]
        assert {r.target for r in rows} == {rows[0].target}
        assert rows[0].target == pytest.approx(target)
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - target) <= 30
    mix = cu.mixed(df)
    assert mix.columns == df.columns
    at = sorted((p, r.doc_id) for r in plan for p in r.positions)
    assert [r.doc_id for r in mix.collect()] == [i for _, i in at]
    again = cu.schedule(df.repartition(7)).collect()
    assert sorted(plan, key=repr) == sorted(again, key=repr)


def test_first_source_is_asked_early_and_third_late(spark):
    texts = ["word " * 10] * 3000
    plan = cu.schedule(docs(spark, texts, ["abc"[i % 3] for i in range(3000)])).collect()
    mean = {}
    for r in plan:
        mean.setdefault(r.src, []).extend(r.positions)
    a, b, c = (sum(mean[f"={s}"]) / len(mean[f"={s}"]) for s in "abc")
    assert a < 0.45 < b < 0.55 < c


def test_odd_rows(spark):
    texts = [None, "", " \n", "one two three", "one two three", "big " * 100_000]
    plan = {r.doc_id: r for r in cu.schedule(docs(spark, texts, ["a", None, "z", "b", "b", "a"])).collect()}
    assert [plan[i].taken for i in (0, 1, 2)] == [0, 0, 0]
    assert plan[1].target == plan[2].target == 0.0
    assert plan[3].target == 18.0 and plan[3].taken == 9
    same = spark.createDataFrame([(None, "x y", None)] * 3 + [(7, "x y", None)] * 2, "doc_id long, text string, source string")
    assert sum(r.taken for r in cu.schedule(same).collect()) == 10
    assert sorted(map(tuple, cu.mixed(same).collect()), key=repr) == sorted(map(tuple, same.collect()), key=repr)
    assert cu.schedule(same.limit(0)).count() == cu.mixed(same.limit(0)).count() == 0
    empty = docs(spark, ["", None], ["a", None])
    assert [r.taken for r in cu.schedule(empty).collect()] == [0, 0] and cu.mixed(empty).count() == 0
