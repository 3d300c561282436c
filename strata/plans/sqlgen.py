"""Small helpers that write the DuckDB oracle SQL for the generated (suffix-driven)
aggregates, so the oracle lists every column the Spark side produces."""

from __future__ import annotations


def suffix_agg_sql(source: str, key: str, cols: list[tuple[str, str]], order: list[str],
                   num=("max", "min", "first", "last", "mean"), strs=("max", "min", "first", "last"),
                   group=("max", "min", "first", "last"), mode=True, name_fmt="{agg}_{col}",
                   round_mean: int | None = None) -> str:
    """Oracle for ``aggregate``: ``cols`` are (name, family) with family in
    num/date/str/other/group, in table order.  first/last via row numbers over ``order``
    (null value kept), mode via counts + row number (ties -> smallest)."""
    fams = {"num": [], "date": [], "str": [], "other": [], "group": []}
    for c, fam in cols:
        fams[fam].append(c)
    sel = []
    mode_cols = []
    for fam in ("num", "date", "str", "other", "group"):
        aggs = {"num": num, "date": num, "str": strs, "other": strs, "group": group}[fam]
        for agg in aggs:
            for c in fams[fam]:
                out = name_fmt.format(agg=agg, col=c)
                if agg in ("max", "min"):
                    sel.append(f"{agg}({c}) AS {out}")
                elif agg == "first":
                    sel.append(f"max(CASE WHEN __rf = 1 THEN {c} END) AS {out}")
                elif agg == "last":
                    sel.append(f"max(CASE WHEN __rl = 1 THEN {c} END) AS {out}")
                elif agg == "mean":
                    if fam == "date":
                        e = f"avg(date_diff('day', DATE '1970-01-01', {c}))"
                    else:
                        e = f"avg({c})"
                    if round_mean is not None and fam != "date":
                        e = f"round({e}, {round_mean})"
                    sel.append(f"{e} AS {out}")
        if fam == "str" and mode:
            for c in fams[fam]:
                out = name_fmt.format(agg="mode", col=c)
                sel.append(f"max(__m_{c}.__mv) AS {out}")
                mode_cols.append(c)
    ordr = ", ".join(order)
    ordd = ", ".join(f"{o} DESC" for o in order)
    joins = ""
    for c in mode_cols:
        joins += (f" LEFT JOIN (SELECT {key}, __mv FROM (SELECT {key}, {c} AS __mv, row_number() OVER "
                  f"(PARTITION BY {key} ORDER BY count(*) DESC, {c}) AS __r FROM __src WHERE {c} IS NOT NULL "
                  f"GROUP BY {key}, {c}) WHERE __r = 1) __m_{c} USING ({key})")
    return (f"(WITH __src AS ({source}), __o AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ordr}) AS __rf, "
            f"row_number() OVER (PARTITION BY {key} ORDER BY {ordd}) AS __rl FROM __src) "
            f"SELECT {key}, {', '.join(sel)} FROM __o{joins} GROUP BY {key})")
