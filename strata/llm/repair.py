"""Conversation structure repair: Wagner-Fischer alignment of turns with the alternating grammar ``(s?(ua)+)?``.

A conversation's rows are numbered in order and each becomes one sign: the initial of its role and its fault.  The signs
are aligned with the grammar's strings of every feasible length: the even ones are the prefixes ``ua``, ``uaua``, ... of
one string, the odd ones those of ``suaua...``, so one cost matrix per string serves all its lengths.  A first narrow
band gives an incumbent cost; a path that strays w cells from the diagonal costs at least 2 w more than the least, which
gives the band that holds every path as cheap as the incumbent.  The cheapest lengths are backtraced over all ties and
their audits compared.  Rows that must go never enter the matrix: deleting them first is always least.

A conversation of more than ``chunk`` rows is never gathered to be aligned.  Its chunks are aligned from each grammar
position to each other one; the position behind a chunk is its end, so a backward fold over the chunks' 4 x 4 costs
gives what every end costs in the rest, with that each chunk is aligned alone, and a forward fold picks the position
in which each begins.  Only those small tables are grouped by conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.schema import join_null_safe
from ..operators.windows import rank_within
from ..session import ensure_checkpoint_dir

INSERT, REROLE, DELETE, BAD_END = 2, 2, 3, 1
BLANKS = "\x20\t\n\x0b\x0c\r"
INITIALS, FAULTS = "suao", ("none", "truncated", "blank", "duplicate")
INF = 1 << 40
ROLE = {"u": "user", "a": "assistant"}
# grammar positions: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a; a conversation may end in 0 and 3
ENDS = (0, INF, INF, 0)


def sign(role: Column, fault: Column) -> Column:
    """A letter from A for (initial, fault number)."""
    initial = F.substring(role, 1, 1)
    at = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + at * 4 + fault)


# ---- alignment of one chunk ------------------------------------------------------------------------------------

def target(position: int, size: int) -> list[str]:
    """The grammar strings that can follow ``position``, as their first ``size`` signs."""
    plain = ("au" if position == 2 else "ua") * (size // 2 + 1)
    return [plain[:size]] + (["s" + plain[:size - 1]] if position == 0 and size else [])


def position_after(position: int, text: str) -> int:
    return "sua".index(text[-1]) + 1 if text else position


class Matrix:
    """Costs of aligning the first i rows with the first j signs of ``text``, in a band of ``width`` cells about i = j."""

    def __init__(self, kinds: np.ndarray, bad_end: np.ndarray, text: str, width: int, ending: bool):
        self.n, self.width, self.text, self.ending = len(kinds), width, text, ending
        self.kinds, self.bad_end = kinds, bad_end
        signs = np.array(["sua".index(c) for c in text], np.int64)
        k = np.arange(2 * width + 1)
        self.rows = []
        prev = None
        for i in range(self.n + 1):
            j = i + k - width
            if i == 0:
                cur = np.where(j == 0, 0, INF)
            else:
                cost = self.swap(i, signs, j)
                cur = np.minimum(np.append(prev[1:], INF) + DELETE, prev + cost)
            cur[(j < 0) | (j > len(text))] = INF
            if i < self.n or ending:
                low = cur - INSERT * k
                if text[:1] == "s":  # no edit inserts an s
                    low[j == 0] = INF
                cur = np.minimum(cur, np.minimum.accumulate(low) + INSERT * k)
                cur[(j < 0) | (j > len(text))] = INF
            self.rows.append(np.minimum(cur, INF))
            prev = self.rows[-1]

    def swap(self, i: int, signs: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Cost of putting row i on sign j (1-based): kept or given another role."""
        ok = (j >= 1) & (j <= len(signs))
        sign_at = signs[np.where(ok, j - 1, 0)] if len(signs) else np.zeros(len(j), np.int64)
        cost = np.where(sign_at == self.kinds[i - 1], 0, np.where(sign_at == 0, INF, REROLE))
        return np.where(ok, cost + self.bad_end[i - 1], INF)

    def at(self, i: int, j: int) -> int:
        k = j - i + self.width
        return int(self.rows[i][k]) if 0 <= k <= 2 * self.width and 0 <= j <= len(self.text) else INF

    def lengths(self):
        """(length, cost) of every length that the band reaches."""
        for j in range(max(0, self.n - self.width), min(len(self.text), self.n + self.width) + 1):
            if self.at(self.n, j) < INF:
                yield j, self.at(self.n, j)

    def edge(self, i: int, j: int, letter: str) -> tuple[int, int] | None:
        """Where the edit leads from (i, j) if it lies on a cheapest path to there."""
        here = self.at(i, j)
        if letter == "I":
            ok = (i < self.n or self.ending) and j < len(self.text) and self.text[j] != "s"
            return (i, j + 1) if ok and self.at(i, j + 1) == here + INSERT else None
        if i == self.n:
            return None
        if letter == "D":
            return (i + 1, j) if self.at(i + 1, j) == here + DELETE else None
        if j == len(self.text):
            return None
        keeps = "sua".index(self.text[j]) == self.kinds[i]
        if keeps != (letter == "K") or not keeps and self.text[j] == "s":
            return None
        cost = (0 if keeps else REROLE) + int(self.bad_end[i])
        return (i + 1, j + 1) if self.at(i + 1, j + 1) == here + cost else None

    def audit(self, length: int) -> str:
        """The ASCII-least of the cheapest audits that end with ``length`` signs."""
        ends = {(self.n, length)}
        seen = set(ends)
        while ends:  # backtrace every tie
            back = set()
            for i, j in ends:
                for a, b, letters in ((i - 1, j, "D"), (i, j - 1, "I"), (i - 1, j - 1, "KR")):
                    if a >= 0 and b >= 0 and (a, b) not in seen and self.at(a, b) < INF:
                        if any(self.edge(a, b, x) == (i, j) for x in letters):
                            back.add((a, b))
            seen |= back
            ends = back
        out, place = [], (0, 0)
        while place != (self.n, length):
            for letter in "DIKR":
                then = self.edge(*place, letter)
                if then in seen:
                    out.append(letter)
                    place = then
                    break
        return "".join(out)


def _rows(codes: str):
    """(initial 0-3 of the rows that may stay, their bad ends, rows to delete before each of them and at the end)."""
    number = np.frombuffer(codes.encode(), np.uint8).astype(np.int64) - 65
    stays = number % 4 < 2
    places = np.flatnonzero(stays)
    gone = np.diff(np.concatenate([[-1], places, [len(number)]])) - 1
    return number[stays] // 4, (number[stays] % 4 == 1) * BAD_END, gone


def _matrices(kinds, bad_end, position: int, width: int, ending: bool):
    return [Matrix(kinds, bad_end, t, width, ending) for t in target(position, len(kinds) + width)]


def align(codes: str, position: int = 0, rest: tuple = ENDS, ending: bool = True) -> tuple[int, str, str, int]:
    """(cost, audit, signs, end position) of the cheapest edits of the rows ``codes`` that begin at a grammar position;
    ``rest`` is what each end position costs afterwards and is part of the cost.  Without ``ending`` the chunk ends with
    its last row: insertions behind it belong to the next chunk."""
    kinds, bad_end, gone = _rows(codes)
    forced = DELETE * int(gone.sum())
    base = int(bad_end.sum()) + min(rest)
    width = 1
    while True:
        best, found = INF, []
        for m in _matrices(kinds, bad_end, position, width, ending):
            for length, cost in m.lengths():
                total = cost + rest[position_after(position, m.text[:length])]
                if (length or m.text[:1] != "s" or position) and total <= min(best, INF - 1):
                    found = [] if total < best else found
                    best = total
                    found.append((m, length))
        if best < INF and best - base < 2 * (width + 1):
            break
        width = (best - base) // 2 if best < INF and (best - base) // 2 > width else 2 * width
    audits = []
    for m, length in found:
        out, row = ["D" * int(gone[0])], 0
        for letter in m.audit(length):
            out.append(letter)
            if letter != "I":
                row += 1
                out.append("D" * int(gone[row]))
        audits.append(("".join(out), m.text[:length]))
    audit, signs = min(audits)
    return best + forced, audit, signs, position_after(position, signs)


def passages(codes: str, ending: bool) -> list[int]:
    """Least cost of the rows from each grammar position to each other one (4 x 4, by rows)."""
    return [passage(codes, p, q, ending) for p in range(4) for q in range(4)]


def passage(codes: str, position: int, end: int, ending: bool) -> int:
    kinds, bad_end, gone = _rows(codes)
    forced = DELETE * int(gone.sum())
    if end == position and end < 2:  # every row goes
        return forced + DELETE * len(kinds)
    if end == 1 and position == 0:  # every row but one s goes
        kept = bad_end[kinds == 0]
        return forced + DELETE * (len(kinds) - 1) + int(kept.min()) if len(kept) else INF
    if end < 2 or not ending and not len(kinds) and end != position:
        return INF
    return align(codes, position, tuple(0 if q == end else INF for q in range(4)), ending)[0]


class Memo(dict):
    """Results by arguments, for one task: most conversations share the signs of others."""

    def of(self, fn, *args):
        if args not in self:
            if len(self) > 1 << 16:
                self.clear()
            self[args] = fn(*args)
        return self[args]


# ---- tables ----------------------------------------------------------------------------------------------------

@dataclass
class Repaired:
    """``audits``: a row per conversation; ``edits``: a row per edit in order, with the repaired role and text."""

    audits: DataFrame
    edits: DataFrame


def _aligned(chunks: DataFrame) -> DataFrame:
    """``c, chunk, cost, audit, edits, roles`` of chunks with ``position, rest, ending``: the letters of the audit, and the
    new role of each edit that gives one."""
    def solve(codes, position, rest, ending):
        cost, audit, signs, _ = align(codes, position, rest, ending)
        it = iter(signs)
        at = [None if x == "D" else next(it) for x in audit]
        return cost, audit, list(audit), [ROLE[c] if x in "RI" else None for x, c in zip(audit, at)]

    def run(batches):
        memo = Memo()
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("codes", "position", "rest", "ending")]
            done = [memo.of(solve, codes, p, tuple(rest), last) for codes, p, rest, last in zip(*cols)]
            cost, audit, edits, roles = zip(*done) if done else ((), (), (), ())
            yield pa.record_batch([batch.column("c"), batch.column("chunk"), pa.array(cost, pa.int64()), pa.array(audit, pa.string()),
                                   pa.array(edits, pa.list_(pa.string())), pa.array(roles, pa.list_(pa.string()))],
                                  names=["c", "chunk", "cost", "audit", "edits", "roles"])

    kind = chunks.schema["c"].dataType.simpleString()
    return chunks.mapInArrow(run, f"c {kind}, chunk bigint, cost bigint, audit string, edits array<string>, roles array<string>")


def _placed(chunks: DataFrame) -> DataFrame:
    """Chunks of long conversations with the position each begins in and the costs behind it."""
    kind = chunks.schema["c"].dataType.simpleString()

    def costs(batches):
        memo = Memo()
        for batch in batches:
            rows = [memo.of(passages, c, e) for c, e in
                    zip(batch.column("codes").to_pylist(), batch.column("ending").to_pylist())]
            yield pa.record_batch([batch.column("c"), batch.column("chunk"), pa.array(rows, pa.list_(pa.int64()))],
                                  names=["c", "chunk", "costs"])

    def backward(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        rest, out = ENDS, []
        for m in reversed(table.column("costs").to_pylist()):
            out.append(list(rest))
            rest = tuple(min(min(m[4 * p + q] + rest[q] for q in range(4)), INF) for p in range(4))
        return pa.table([table.column("c"), table.column("chunk"), pa.array(out[::-1], pa.list_(pa.int64())),
                         table.column("costs")], names=["c", "chunk", "rest", "costs"])

    def ends(codes, rest, costs, last):  # -1: nothing leads on from the position
        can = [any(costs[4 * p + q] + rest[q] < INF for q in range(4)) for p in range(4)]
        return [align(codes, p, rest, last)[3] if can[p] else -1 for p in range(4)]

    def moves(batches):
        memo = Memo()
        for batch in batches:
            cols = (batch.column(n).to_pylist() for n in ("codes", "rest", "costs", "ending"))
            out = [memo.of(ends, codes, tuple(rest), tuple(costs), last) for codes, rest, costs, last in zip(*cols)]
            yield pa.record_batch([batch.column("c"), batch.column("chunk"), pa.array(out, pa.list_(pa.int32()))],
                                  names=["c", "chunk", "moves"])

    def forward(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        p, out = 0, []
        for m in table.column("moves").to_pylist():
            out.append(p)
            p = m[p]
        return pa.table([table.column("c"), table.column("chunk"), pa.array(out, pa.int32())], names=["c", "chunk", "position"])

    key = ["c", "chunk"]
    m = chunks.mapInArrow(costs, f"c {kind}, chunk bigint, costs array<bigint>")
    rest = m.groupBy("c").applyInArrow(backward, f"c {kind}, chunk bigint, rest array<bigint>, costs array<bigint>")
    known = join_null_safe(chunks, rest, key).checkpoint(eager=True)
    step = known.mapInArrow(moves, f"c {kind}, chunk bigint, moves array<int>")
    begin = step.groupBy("c").applyInArrow(forward, f"c {kind}, chunk bigint, position int")
    return join_null_safe(known.drop("costs"), begin, key)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk: int = 256) -> Repaired:
    """Audit and repair every conversation.

    Rows are taken by turn (nulls first), then role and text; null roles and texts are one space; rows with a null
    conversation id form one conversation.  A row's first fault counts: blank (nothing but 0x20 and 0x09-0x0D), duplicate
    (role and text came before), truncated (the last other character is none of ``.!?``).  Edits: Keep 0, Rerole to user or
    assistant 2, Delete 3 (blank and duplicate rows must go), Insert an empty user or assistant turn 2; a truncated row
    that stays adds 1.  The cheapest edits whose role initials give ``(s?(ua)+)?`` win, of equal ones the ASCII-least audit.

    ``audits``: conv, gaps (missing whole numbers between the turns), blank, duplicate, truncated, illegal (neighbours
    whose initials are not su, ua or au), cost, audit.  ``edits``: conv, seq (orders a conversation's edits), edit (K, R, D
    or I), role, text (null for a deleted row), pos (0-based source row, null for an inserted one).  An empty table gives
    empty tables; other columns are not read, whatever their names."""
    ensure_checkpoint_dir(turns.sparkSession)
    x = turns.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                     F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    x = rank_within(x, "c", ["turn", "role", "text"], alias="pos", count_alias="n")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    shown = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(shown == "", 2).when(~F.substring(shown, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    slim = x.select("c", "turn", "pos", "n", F.floor(F.col("pos") / chunk).alias("chunk"), said.alias("said"), "role",
                    fault.alias("fault")).checkpoint(eager=True)
    again = (slim.groupBy("c", "said").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("times"))
             .filter("times > 1").select("c", "said", "first"))
    slim = join_null_safe(slim, again, ["c", "said"], how="left")
    fault = F.when((F.col("fault") != 2) & (F.col("pos") > F.col("first")), 3).otherwise(F.col("fault"))
    signs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", sign(F.col("role"), fault).alias("s")))),
                                     lambda r: r["s"]), "")
    chunks = slim.groupBy("c", "chunk").agg(signs.alias("codes"), F.max("n").alias("n"))
    chunks = chunks.withColumn("ending", (F.col("chunk") + 1) * chunk >= F.col("n")).checkpoint(eager=True)
    whole = chunks.filter(F.col("n") <= chunk).withColumns({
        "position": F.lit(0), "rest": F.array(*[F.lit(e).cast("bigint") for e in ENDS])})
    cols = ["c", "chunk", "codes", "ending", "rest", "position"]
    ready = whole.select(*cols)
    long = chunks.filter(F.col("n") > chunk)
    if not long.isEmpty():
        ready = ready.unionByName(_placed(long).select(*cols))
    done = _aligned(ready).checkpoint(eager=True)

    letters = F.col("codes")
    kinds = lambda f: F.length(F.regexp_replace(letters, f"[^{''.join(chr(65 + 4 * i + f) for i in range(4))}]", ""))
    initials = F.translate(letters, "".join(chr(65 + i) for i in range(16)), "".join(INITIALS[i // 4] for i in range(16)))
    pairs = F.filter(F.sequence(F.lit(1), F.length("w") - 1), lambda i: ~F.substr(F.col("w"), i, F.lit(2)).isin("su", "ua", "au"))
    inside = F.when(F.length("w") > 1, F.size(pairs)).otherwise(0)
    per = (chunks.select("c", "chunk", initials.alias("w"), kinds(2).alias("blank"), kinds(3).alias("duplicate"), kinds(1).alias("truncated"))
           .withColumn("inside", inside))
    seams = join_null_safe(per.select("c", (F.col("chunk") + 1).alias("chunk"), F.substr("w", F.lit(-1), F.lit(1)).alias("before")),
                           per.select("c", "chunk", F.substring("w", 1, 1).alias("after")), ["c", "chunk"])
    seams = seams.groupBy("c").agg(F.sum((~F.concat("before", "after").isin("su", "ua", "au")).cast("bigint")).alias("seams"))
    per = per.groupBy("c").agg(*[F.sum(n).cast("bigint").alias(n) for n in ("blank", "duplicate", "truncated", "inside")])
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = F.least(wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(F.count_distinct("turn")), F.lit((1 << 63) - 1)).cast("bigint")
    spread = slim.groupBy("c").agg(F.when(F.max("turn").isNull(), 0).otherwise(gaps).alias("gaps"))
    # the rest's cost is part of each chunk's: the first chunk's cost is the whole's
    first = done.filter("chunk = 0").select("c", "cost")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda r: r["audit"]), "")
    audits = done.groupBy("c").agg(joined.alias("audit"))
    for part in (first, per, spread):
        audits = join_null_safe(audits, part, ["c"])
    audits = join_null_safe(audits, seams, ["c"], how="left").select(
        F.col("c").alias(conv), "gaps", "blank", "duplicate", "truncated",
        (F.col("inside") + F.coalesce("seams", F.lit(0))).cast("bigint").alias("illegal"), "cost", "audit")

    steps = done.select("c", "chunk", "audit", F.posexplode(F.arrays_zip("edits", "roles")).alias("at", "e"))
    row = F.length(F.replace(F.substr("audit", F.lit(1), F.col("at")), F.lit("I"), F.lit("")))  # rows before this edit
    steps = steps.select("c", "chunk", "at", F.col("e.edits").alias("edit"), F.col("e.roles").alias("new_role"),
                         F.when(F.col("e.edits") != "I", F.col("chunk") * chunk + row).alias("pos"))
    src = x.select("c", "pos", "role", "text")
    edits = join_null_safe(steps, src, ["c", "pos"], how="left")
    stays = F.col("edit") != "D"
    edits = edits.select(F.col("c").alias(conv), F.struct("chunk", "at").alias("seq"), "edit",
                         F.when(stays, F.coalesce("new_role", "role")).alias("role"),
                         F.when(F.col("edit") == "I", "").when(stays, F.col("text")).alias("text"), "pos")
    return Repaired(audits, edits)
