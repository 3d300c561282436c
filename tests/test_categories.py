"""All category columns aligned at once: the probed table and the melted join against a plain Python rule."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import encode as E

COLS = [f"c{i}" for i in range(30)]


def _rows(seed, n, values):
    r = random.Random(seed)
    return [tuple([k] + [r.choice(values + [None]) for _ in COLS]) for k in range(n)]


def _table(spark, rows):
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} string" for c in COLS))


def _want(train, rows, unknown="Unknown", missing="Missing"):
    out = {}
    dicts = [sorted({t[j + 1] for t in train} - {None}) for j in range(len(COLS))]
    for row in rows:
        got = []
        for v, d in zip(row[1:], dicts):
            codes = {x: i for i, x in reversed(list(enumerate(d + ["Unknown"])))} if d else {}
            name = missing if v is None else v if v in codes else unknown
            got.append((name, codes.get(name, -1) if name is not None else -1))
        out.setdefault(row[0], []).append(got)
    return out


def _got(frame):
    return {r["id"]: [[(r[c], r[f"{c}_code"]) for c in COLS]] for r in frame.collect()}


@pytest.mark.parametrize("room", [4 << 20, 0])
@pytest.mark.parametrize("missing", ["Missing", None])
def test_thirty_columns_at_once(spark, room, missing):
    train = _rows(1, 40, ["a", "b", "1:a", "", "Unknown", "é"])
    rows = _rows(2, 60, ["a", "b", "1:a", "", "Unknown", "é", "new", "0:a"])
    rows += [tuple([1000 + i] + [None] * 30) for i in range(3)] + [tuple([2000 + i] + ["new"] * 30) for i in range(3)]
    got = E.align_categories(_table(spark, rows), E.fit_dictionary(_table(spark, train), COLS), COLS, missing=missing,
                             table_bytes=room)
    assert got.columns == ["id", *COLS, *[f"{c}_code" for c in COLS]]
    assert _got(got) == _want(train, rows, missing=missing)


@pytest.mark.parametrize("room", [4 << 20, 0])
def test_repeated_rows_stay_and_empty_tables_work(spark, room):
    train = _table(spark, _rows(1, 10, ["a", "b"]))
    d = E.fit_dictionary(train, COLS)
    twice = _table(spark, _rows(3, 5, ["a", "z"])).withColumn("id", F.lit(7))
    out = E.align_categories(twice.unionByName(twice), d, COLS, table_bytes=room)
    assert out.count() == 10
    assert E.align_categories(twice.limit(0), d, COLS, table_bytes=room).count() == 0
    none = E.align_categories(twice, d.limit(0), COLS, table_bytes=room).collect()
    assert len(none) == 5 and {(r["c0"], r["c0_code"]) for r in none} <= {("Unknown", -1), ("Missing", -1)}


def test_no_join_per_column(spark):
    d = E.fit_dictionary(_table(spark, _rows(1, 40, ["a", "b"])), COLS).checkpoint()
    rows = _table(spark, _rows(2, 40, ["a", "c"]))

    def joins(frame):
        text = frame._jdf.queryExecution().optimizedPlan().toString()
        main = [ln for ln in text.splitlines() if "Join " in ln]
        return len(main)

    probed = E.align_categories(rows, d, COLS)
    joined = E.align_categories(rows, d, COLS, table_bytes=0)
    assert joins(joined) == 2  # cells with entries, codes back to rows
    text = probed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text.split("Subquery")[0]
