"""Keyed result store, cell join, narrowed quantiles, fold models and posting-list retrieval on small fixtures."""

from __future__ import annotations

import math
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import aggregate as A
from strata.operators import joins as J
from strata.operators import model as ML
from strata.operators import retrieval as R
from strata.session import ensure_checkpoint_dir
from strata.sources.io import read_chunks, schema_groups
from strata.sources.store import KeyedStore


@pytest.fixture
def place(spark):
    return f"{ensure_checkpoint_dir(spark)}/store-test-{uuid.uuid4().hex}"


def data_files(place):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{place}/data") for f in fs if f.endswith(".parquet"))


@pytest.mark.parametrize("verify", ["content", "size"])
def test_store_builds_only_what_is_absent_or_damaged(spark, place, verify):
    store = KeyedStore(spark, place, ["study", "size"], verify=verify)
    calls = []

    def compute(keys):
        calls.append({tuple(r) for r in keys.collect()})
        return (keys.filter("study <> 'none' OR study IS NULL")
                .withColumn("v", F.explode(F.array(F.lit(1), F.lit(2)))))

    wanted = lambda *keys: spark.createDataFrame(list(keys), "study string, size int")
    key = [("a", 1), ("a", 2), (None, 1), ("none", 1)]
    got = store.get(wanted(*key, ("a", 1)), compute)
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for s, z in key[:3] for r in spark.createDataFrame(
        [(s, z, 1), (s, z, 2)], "study string, size int, v int").collect()]))
    assert calls == [set(key)]
    assert store.get(wanted(*key[:2]), compute).count() == 4 and len(calls) == 1  # all there, empty results too
    store.get(wanted(*key, ("b", 3)), compute)
    assert calls[1] == {("b", 3)}
    for f in data_files(place)[:1]:
        held = {tuple(r) for r in spark.read.parquet(f).select("study", "size").distinct().collect()}
        with open(f, "wb") as out:
            out.write(b"broken")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert held
    got = store.get(wanted(*key, ("b", 3)), compute)
    assert calls[2] == held and got.count() == 8 and got.distinct().count() == 8


def test_store_whose_keys_have_no_rows(spark, place):
    store = KeyedStore(spark, place, ["k"])
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    calls = []

    def none(k):
        calls.append(1)
        return k.filter("k < 0").withColumn("v", F.lit("x"))

    assert store.get(keys, none).columns == ["k", "v"]
    assert store.get(keys, none).count() == 0
    assert store.missing(keys).count() == 0


def test_points_in_boxes_equal_the_nested_loop(spark):
    r = random.Random(4)
    pts = [(i, r.choice("ab"), r.uniform(-9, 9), float(r.randrange(-3, 4))) for i in range(300)]
    pts += [(900, "a", None, 1.0), (901, "a", float("nan"), 1.0), (902, None, 0.0, 0.0), (903, "z", 0.0, 0.0)]
    boxes = []
    for b in range(120):
        x, y, w, h = r.uniform(-9, 9), float(r.randrange(-3, 4)), r.choice([0, .1, 1, 7, 40]), r.choice([0, 1, 5])
        boxes.append((b, r.choice("ab"), x, x + w, y, y + h))
    boxes += [(900, "a", 1.0, 0.0, 0.0, 1.0), (901, "a", None, 1.0, 0.0, 1.0), (902, None, -9.0, 9.0, -9.0, 9.0),
              (903, "b", 0.0, float("nan"), 0.0, 1.0)]
    p = spark.createDataFrame(pts, "id int, s string, x double, y double")
    b = spark.createDataFrame(boxes, "box int, s string, x0 double, x1 double, y0 double, y1 double")
    got = {(t["id"], t["box"]) for t in J.points_in_boxes(p, b, "s", ["x", "y"], ["x0", "y0"], ["x1", "y1"]).collect()}
    ok = lambda v: v is not None and v == v
    want = {(i, k) for i, s, x, y in pts for k, t, x0, x1, y0, y1 in boxes
            if s is not None and s == t and all(map(ok, (x, y, x0, x1))) and x0 <= x <= x1 and y0 <= y <= y1}
    assert got == want and len(want) > 100
    counts = {t["id"]: t for t in J.box_counts(p, b, ["id"], "s", ["x", "y"], ["x0", "y0"], ["x1", "y1"], "box").collect()}
    assert len(counts) == len(pts) and counts[903]["n_missed"] == 0
    assert all(counts[i]["n_inside"] == sum(k == i for k, _ in want) for i in counts)
    assert counts[0]["n_inside"] + counts[0]["n_missed"] == sum(t == pts[0][1] for _, t, *_ in boxes)
    assert J.points_in_boxes(p, b.limit(0), "s", ["x", "y"], ["x0", "y0"], ["x1", "y1"]).count() == 0


@pytest.mark.parametrize("room", [8, 1 << 18])
def test_narrowed_quantiles_equal_numpy(spark, room):
    r = np.random.default_rng(room)
    cols = {"a": r.normal(size=500), "b": r.integers(0, 4, 500).astype(float), "c": 10.0 ** r.integers(-200, 200, 500),
            "d": np.full(500, 7.0), "e": np.where(r.random(500) < .2, np.inf, r.random(500))}
    rows = [tuple(float(v[i]) for v in cols.values()) + (None,) for i in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*cols, "none"])).repartition(3)
    probs = [0, .001, .25, .5, .75, 1]
    got = A.narrowed_quantiles(df, [*cols, "none"], probs, room=room, rounds=3)
    for c, v in cols.items():
        with np.errstate(invalid="ignore"):
            want = np.quantile(v, probs)
        for x, y in zip(got[c], want):
            assert math.isclose(x, y, rel_tol=1e-9) or (math.isinf(y) and x == y) or (y != y), (c, x, y)
    assert got["none"] == [None] * len(probs)
    assert A.narrowed_quantiles(df.limit(0), ["a"], [.5]) == {"a": [None]}


def test_profile_reads_the_table_a_few_times_for_all_columns(spark):
    df = spark.createDataFrame([(i, float(i), "x", i * 2) for i in range(101)], "i int, d double, s string, j bigint")
    got = {r["column"]: r for r in A.profile(df).collect()}
    assert (got["d"]["p25"], got["j"]["p50"], got["i"]["p75"]) == (25.0, 100.0, 75.0) and got["s"]["p50"] is None


def test_joined_names_stay_unique(spark):
    a = spark.createDataFrame([(1, 1, 2)], "k int, a int, a_0 int")
    b = spark.createDataFrame([(1, 3, 4)], "k int, a int, a_0 int")
    out = J.left_join_suffixed(a, b, "k", "_0")
    assert len(set(out.columns)) == len(out.columns) == 5 and sorted(out.first()) == [1, 1, 2, 3, 4]


def test_complete_groups_keep_the_null_key(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "k int, s string")
    assert [r["k"] for r in A.complete_groups(df, "k", "s", {"a": 2}).collect()] == [None, None]


@pytest.mark.parametrize("folds", [[1, 2, 3], ["x", "y", "z"]])
def test_rows_are_scored_by_the_model_of_their_fold_value(spark, folds):
    kind = "int" if isinstance(folds[0], int) else "string"
    rows = [(i, folds[i % 3], float(i % 7), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, f"id int, fold {kind}, x double, label int")
    models = ML.fit_folds(df, ["x"], [], "label", "fold", max_iter=2, max_depth=2)
    assert [m.fold for m in models] == folds and all(m.trees == 2 for m in models)
    got = {r["id"]: r["score"] for r in ML.score_folds(models, df, "id", fold="fold").collect()}
    for m in models:  # each row's score is that of its own model alone
        alone = {r["id"]: r["score"] for r in ML.score_folds([m], df.filter(F.col("fold") == m.fold), "id").collect()}
        assert all(abs(got[i] - s) < 1e-12 for i, s in alone.items()) and len(alone) == 40
    with pytest.raises(Exception, match="no model for fold"):
        ML.score_folds(models[:2], df, "id", fold="fold").collect()


def test_early_stopping_keeps_few_trees_of_noise(spark):
    r = random.Random(6)
    rows = [(i, i % 2, r.random(), r.randrange(2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, fold int, x double, label int")
    full = ML.fit_folds(df, ["x"], [], "label", "fold", max_iter=8, max_depth=4)
    short = ML.fit_folds(df, ["x"], [], "label", "fold", max_iter=8, max_depth=4, early_stop=True)
    assert all(m.trees == 8 for m in full) and all(1 <= m.trees < 8 for m in short)


def test_ordered_target_stats_never_see_their_own_label(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"l{i % 3}", i % 2) for i in range(40)], "id int, c string, y int")
    got = {r["id"]: r["c_ts"] for r in ML.ordered_target_stats(df, ["c"], "y", "id").collect()}
    flip = df.withColumn("y", F.when(F.col("id") == 7, 1 - F.col("y")).otherwise(F.col("y")))
    moved = {r["id"]: r["c_ts"] for r in ML.ordered_target_stats(flip, ["c"], "y", "id").collect()}
    assert len(got) == 40 and abs(got[7] - moved[7]) <= 1 / 40 + 1e-12  # the flipped row changes by the prior at most
    new = spark.createDataFrame([(1, "l1"), (2, "new"), (3, None)], "id int, c string")
    out = {r["id"]: r["c_ts"] for r in ML.target_stats_of(df, new, ["c"], "y").collect()}
    assert out[2] == 0.5 and 0 < out[1] < 1 and 0 < out[3] < 1


@pytest.mark.parametrize("list_rows, seed_rows", [(3, 1), (1 << 20, 4096), (1, 50)])
def test_posting_lists_equal_all_scores(spark, list_rows, seed_rows):
    r = random.Random(list_rows)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(words[min(int(r.expovariate(.15)), 39)] for _ in range(n))
    docs = [(i, text(r.choice([1, 5, 30]))) for i in range(80)] + [(90, None), (91, "")]
    qs = [(i, text(8)) for i in range(6)] + [(7, "unknown"), (8, None)]
    d = spark.createDataFrame(docs, "id bigint, t string")
    q = spark.createDataFrame(qs, "q bigint, t string")
    got = sorted(map(tuple, R.text_top_k(q, d, 5, "q", "t", "id", "t", list_rows=list_rows, seed_rows=seed_rows).collect()))
    n, df = len(docs), {}
    split = lambda t: (t or "").split()
    for _, t in docs:
        for w in set(split(t)):
            df[w] = df.get(w, 0) + 1

    def vector(t):
        v = {w: split(t).count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in set(split(t)) if w in df}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    want = []
    for k, t in qs:
        a = vector(t)
        s = []
        for i, u in docs:
            b = vector(u)
            if set(a) & set(b):
                s.append((-round(sum(x * b.get(w, 0) for w, x in a.items()), 6), i))
        want += [(k, j, i, -v) for j, (v, i) in enumerate(sorted(s)[:5], 1)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, sorted(want)))


def test_schemas_come_back_once_each(spark, place):
    for i in range(6):
        kind = "int" if i % 2 else "double"
        spark.createDataFrame([(i,)], "a int").select(F.col("a").cast(kind)).coalesce(1).write.parquet(f"{place}/c_{i}.parquet")
    groups = schema_groups(spark, [f"{place}/c_{i}.parquet" for i in range(6)])
    assert [[f[-9] for f in files] for _, files in groups] == [["0", "2", "4"], ["1", "3", "5"]]
    assert sorted(r["a"] for r in read_chunks(spark, [f"{place}/c_{i}.parquet" for i in range(6)], typed=False).collect()) == [0, 1, 2, 3, 4, 5]


# ---- J1: bucketed chain ----------------------------------------------------------------------------------------

def test_bucketed_chain_has_no_exchange(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    one = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    two = spark.createDataFrame([(2, 5)], "k int, n int")
    tables = [J.bucketed(t, "k", 4) for t in (base, one, two)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.join_all(tables[0], tables[1:], on="k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = {tuple(r) for r in out.collect()}
        grouped = tables[0].groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Exchange" not in grouped
    assert out.columns == ["k", "v", "v_0", "n"]
    assert rows == {(1, "a", "x", None), (2, "b", None, 5), (None, "c", None, None)}
