"""Steps whose cost must not grow faster than the input: the same results with tiny blocks, and plans without the costly step."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import geometry as GO
from strata.operators import joins as J
from strata.operators import retrieval as R
from strata.operators import windows as W


@pytest.mark.parametrize("point_rows, box_rows", [(1 << 17, 1 << 19), (40, 16)])
def test_boxes_are_counted_without_pairs(spark, point_rows, box_rows):
    r = random.Random(8)
    pts = [(i, r.choice("ab"), r.uniform(-9, 9), float(r.randrange(-3, 4))) for i in range(400)]
    pts += [(1000 + i, "a", 1.0, 1.0) for i in range(120)] + [(None, "b", 0.0, 0.0), (5, "b", 2.0, 0.0)]
    boxes = []
    for b in range(150):
        x, y, w, h = r.uniform(-9, 9), float(r.randrange(-3, 4)), r.choice([0, .1, 1, 7, 40]), r.choice([0, 1, 5])
        boxes.append((b, r.choice("ab"), x, x + w, y, y + h))
    boxes += [(-5, "a", 0.5, 1.5, 0.5, 1.5), (None, "b", -9.0, 9.0, -9.0, 9.0), (7, "a", 2.0, 1.0, 0.0, 1.0)]
    p = spark.createDataFrame(pts, "id int, s string, x double, y double")
    b = spark.createDataFrame(boxes, "box int, s string, x0 double, x1 double, y0 double, y1 double")
    hits = J.box_hits(p, b, ["id"], "s", ["x", "y"], ["x0", "y0"], ["x1", "y1"], "box", point_rows, box_rows)
    got = {t["id"]: (t["n"], t["first"]) for t in hits.groupBy("id").agg(F.sum("__n").alias("n"), F.min("__first").alias("first")).collect()}
    want = {}
    for i, s, x, y in pts:
        held = [k for k, t, x0, x1, y0, y1 in boxes if s == t and x0 <= x <= x1 and y0 <= y <= y1]
        if held:
            n, first = want.get(i, (0, None))
            want[i] = (n + len(held), min([k for k in held if k is not None] + ([first] if first is not None else []), default=None))
    assert got == want and len(want) > 300


def _slices(spark):
    r = random.Random(3)
    rows = []
    for i in range(300):
        tilt = r.choice([[1.0, 0.0, 0.0, 0.0, 1.0, 0.0], [1.0, 0.0, 0.0, 0.0, 0.8, 0.6], [0.0, 1.0, 0.0, 0.0, 0.0, -1.0], None])
        series = r.choice([None, 1, 2, 2, 2, 3])
        rows.append((r.choice([1, 2]), series, i, tilt, [float(r.randrange(3)), 0.0, float(r.randrange(9))], [0.5, 0.5], 2.0, 256, 256))
    return spark.createDataFrame(rows, "study_id int, series_id int, instance_number int, orientation array<double>, "
                                       "position array<double>, spacing array<double>, gap double, W int, H int")


def test_ranks_of_small_groups_need_one_exchange(spark):
    df = spark.createDataFrame([(None if i % 7 == 0 else i % 3, i * 37 % 100) for i in range(100)], "g int, v int")
    r = W.rank_within(df, "g", [W.Desc("v")], alias="r", count_alias="n")
    hot = W.rank_within(df, "g", [W.Desc("v")], alias="r", count_alias="n", hot_rows=20)
    assert r.columns == hot.columns == ["g", "v", "n", "r"] and r.dtypes == hot.dtypes
    assert sorted(map(str, r.collect())) == sorted(map(str, hot.collect()))
    plan = r.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_slices_of_small_and_large_series_are_ordered_alike(spark, monkeypatch):
    s = _slices(spark)
    small = GO.slice_order(s)
    monkeypatch.setattr(GO, "split_hot", lambda df, by: W.split_hot(df, by, 60))
    large = GO.slice_order(s)
    assert small.columns == large.columns and small.dtypes == large.dtypes
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("same", [True, False])
def test_backprojected_rows_are_not_moved_to_the_slices(spark, same):
    ordered = GO.slice_order(_slices(spark)).localCheckpoint()
    pts = ordered.select("study_id", "series_id", "instance_number", F.col("position").alias("world"))
    results = [GO.backproject(pts, GO.stack_frames(ordered), ordered, "world", same_series=same, list_rows=n) for n in (256, 8, 0)]
    rows = [sorted(map(str, x.collect())) for x in results]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 100
    assert any("inside=True" in x for x in rows[0])


def test_block_scores_are_held_in_pieces(monkeypatch):
    import pandas as pd
    r = np.random.default_rng(1)
    q = pd.DataFrame({"id": range(50), "vec": [*r.random((49, 4)), np.zeros(4)]})
    c = pd.DataFrame({"id": range(100, 170), "vec": list(r.random((70, 4)))})
    sizes = []
    local = R._local_top_k
    monkeypatch.setattr(R, "_local_top_k", lambda a, b, s, k: (sizes.append(s.size), local(a, b, s, k))[1])
    whole = R._dense_scores(q, c, 5)
    monkeypatch.setattr(R, "SCORES", 200)
    pieces = R._dense_scores(q, c, 5)
    assert sizes[0] == 49 * 70 and max(sizes[1:]) <= 200 and len(sizes) > 10
    pd.testing.assert_frame_equal(whole, pieces)
    assert len(R._dense_scores(q[49:], c, 5)) == 0


@pytest.mark.parametrize("name", ["feature_build_train", "feature_build_score"])
def test_the_build_is_made_once(spark, monkeypatch, name):
    from strata.plans import features
    df = getattr(features, name)(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "lineitem" not in plan.lower() and "l_orderkey" not in plan
