"""Conversation structure repair by Four-Russians block tables.

A conversation's turns become a string of symbols: a turn that must go (blank, or a
copy of an earlier turn), else its role's initial and whether its text breaks off.
Edits (delete, keep, change the role, insert an empty turn) drive a machine of four
states; the cheapest edits that end in an accepted state are sought.

The costs to the end from the four states, less their least, form one of few vectors.
For every vector and every block of ``BLOCK`` symbols a table gives the vector before
the block and what was taken off, so costs run through a conversation from its end
by one look-up a block.  To trace, a block is expanded backward from the vector at
its end: the vectors inside tell which edits are tight at each place, and reading
them forward, the ASCII-least tight letter is taken.  In a given state a letter leads
to one place only, so this gives the least of all cheapest edit strings.  Expanded
blocks are remembered by worker.

One conversation may hold a third of all rows.  Turns are sorted across the cluster
into parts of bounded size, so such a conversation lies in many parts.  Each part gives
a 4 x 4 table of least costs through it, a conversation's tables are chained from its
end (one small row per part), each part then tells where each state leads, and the
final pass repairs all parts independently.  Only a conversation's checksum is taken
in order, streaming over its repaired parts, as SHA-256 cannot be split.

Defined cases: a null role or text counts as one space; a null id is a conversation of
its own; null turns come first and do not count as turns; turns of one number are
ordered by role and text; repeated rows are duplicates; rows that are not present only
name their conversation; an empty table gives no rows; very long texts are whole
values; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune, worker_memory

PART_ROWS = 50_000
PART_BYTES = 32 << 20
BLOCK = 4
WHITE = " \t\n\x0b\x0c\r"

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
NEXT = (2, 2, 3, 2)             # state after a user or assistant turn that fits
ROLE_OF = {2: "user", 3: "assistant"}
ACCEPTED = (0, 3)
DELETE, RENAME, INSERT, TRUNCATED = 2, 1, 5, 5
SYMBOLS = 9                     # 0: must go; else 1 + 2 * role (s, u, a, other) + breaks off
NONE = 1 << 40                  # no way; sums of few stay exact


def _row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that use up a turn, letters ascending."""
    edits = [("D", DELETE, state)]
    if symbol:
        role, late = (symbol - 1) // 2, (symbol - 1) % 2 * TRUNCATED
        to = NEXT[state]
        if role == 0 and state == 0:
            edits.append(("K", late, 1))
        elif (role == 1 and to == 2) or (role == 2 and to == 3):
            edits.append(("K", late, to))
        edits.append(("R", RENAME + late, to))
    return edits


def _with_inserts(cost: tuple[int, ...]) -> tuple[int, ...]:
    """Costs when empty turns may be inserted first (two at most ever pay)."""
    for _ in range(2):
        cost = tuple(min(c, INSERT + cost[NEXT[q]]) for q, c in enumerate(cost))
    return cost


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before a turn, from those after it."""
    return _with_inserts(tuple(min(cost + after[to] for _, cost, to in _row_edits(symbol, q)) for q in range(4)))


def _normal(cost: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(cost)
    return tuple(c - least if c < NONE else NONE for c in cost), least


LAST = _with_inserts(tuple(0 if q in ACCEPTED else NONE for q in range(4)))
UNITS = [tuple(0 if q == end else NONE for q in range(4)) for end in range(4)]


class BlockTables:
    """Every reachable normalised vector, and its transition for every block of symbols."""

    def __init__(self):
        self.number, self.vectors = {}, []
        queue, step, added = deque(), [], []
        for seed in (LAST, *UNITS):
            self._known(_normal(seed)[0], queue)
        while queue:
            vector = self.vectors[queue.popleft()]
            before = [_normal(_before(x, vector)) for x in range(SYMBOLS)]
            step.append([self._known(v, queue) for v, _ in before])
            added.append([a for _, a in before])
        self.step, self.step_cost = np.array(step), np.array(added)
        # Block tables: a block's number reads its symbols as digits, the first the highest.
        self.block, self.block_cost = self.step, self.step_cost
        for _ in range(BLOCK - 1):
            # one symbol more, put behind: first the step over it, then the table so far
            inner, cost = self.block[self.step], self.block_cost[self.step]          # vector, last symbol, earlier ones
            self.block = inner.transpose(0, 2, 1).reshape(len(step), -1)
            self.block_cost = (cost + self.step_cost[:, :, None]).transpose(0, 2, 1).reshape(len(step), -1)
        self.look, self.look_cost = self.block.tolist(), self.block_cost.tolist()
        self.expanded: dict[tuple, list[tuple[str, int]]] = {}

    def _known(self, vector, queue) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
            queue.append(self.number[vector])
        return self.number[vector]

    def _blocks(self, symbols: list[int]) -> Iterator[tuple[int, ...]]:
        """The blocks from the last to the first; the first may be shorter."""
        for end in range(len(symbols), 0, -BLOCK):
            yield tuple(symbols[max(0, end - BLOCK):end])

    def back(self, symbols: list[int], vector: int) -> tuple[int, int, list[tuple[tuple[int, ...], int]]]:
        """(vector before all symbols, costs taken off, blocks with the vector behind each, first block first)."""
        total, trail = 0, []
        for block in self._blocks(symbols):
            trail.append((block, vector))
            if len(block) == BLOCK:
                code = 0
                for x in block:
                    code = code * SYMBOLS + x
                total += self.look_cost[vector][code]
                vector = self.look[vector][code]
            else:
                for x in reversed(block):
                    total += int(self.step_cost[vector, x])
                    vector = int(self.step[vector, x])
        return vector, total, trail[::-1]

    def expand(self, block: tuple[int, ...], vector: int) -> list[tuple[str, int]]:
        """For each state before the block: least tight letters, and the state after it."""
        found = self.expanded.get((block, vector))
        if found is None:
            costs = [self.vectors[vector]]
            for x in reversed(block):
                costs.append(_before(x, costs[-1]))
            costs.reverse()
            found = self.expanded[block, vector] = [self._trace(block, costs, q) for q in range(4)]
        return found

    @staticmethod
    def _trace(block, costs, state: int) -> tuple[str, int]:
        letters, at = [], 0
        if costs[0][state] >= NONE:
            return "", state
        while at < len(block):
            here = costs[at][state]
            ways = {letter: (at + 1, to) for letter, cost, to in _row_edits(block[at], state) if cost + costs[at + 1][to] == here}
            if INSERT + costs[at][NEXT[state]] == here:
                ways["I"] = (at, NEXT[state])
            letter = min(ways)
            letters.append(letter)
            at, state = ways[letter]
        return "".join(letters), state

    def walk(self, trail, state: int) -> tuple[str, int]:
        """Letters through the blocks of ``back`` from ``state``, and the state behind them."""
        letters = []
        for block, vector in trail:
            some, state = self.expand(block, vector)[state]
            letters.append(some)
        return "".join(letters), state

    def through(self, symbols: list[int]) -> list[int]:
        """Least costs from each state before the symbols to each behind them (16 numbers)."""
        columns = []
        for unit in UNITS:
            vector, total, _ = self.back(symbols, self.number[unit])
            columns.append([c + total if c < NONE else NONE for c in self.vectors[vector]])
        return [columns[to][start] for start in range(4) for to in range(4)]


def _tables() -> BlockTables:
    return worker_memory("conversation blocks", BlockTables)


def _symbols(rows: pd.DataFrame) -> list[int]:
    role = {"s": 0, "u": 1, "a": 2}
    return [0 if blank or double else 1 + 2 * role.get(initial, 3) + int(late)
            for blank, double, initial, late in zip(rows["blank"], rows["double"], rows["initial"], rows["truncated"])]


def _conversations(turns: pd.DataFrame, notes: pd.DataFrame) -> Iterator[tuple[str, pd.DataFrame]]:
    """A part's conversations in order, duplicates marked; rows that are not present are left out."""
    turns = turns.sort_values("pos").reset_index(drop=True)
    turns["double"] = turns["pos"].isin(notes["pos"].dropna().astype("int64"))
    keys = turns["key"].to_list()
    for key, numbers in groupby(range(len(keys)), keys.__getitem__):
        numbers = list(numbers)
        rows = turns.iloc[numbers[0]:numbers[-1] + 1]
        yield key, rows[rows["present"]]


def _lines(rows: pd.DataFrame, letters: str, state: int) -> list[str]:
    """The repaired turns as ``role:text``; letters behind the last turn insert."""
    lines, each = [], iter(zip(rows["role"], rows["text"], rows["initial"]))
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            lines.append(ROLE_OF[state] + ":")
            continue
        role, text, initial = next(each)
        if letter == "K":
            state = 1 if initial == "s" else NEXT[state]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = NEXT[state]
            lines.append(f"{ROLE_OF[state]}:{text}")
    return lines


PIECE = ("key string, part int, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
         "least long, most long, turns long, cost long, audit string, kept long, repaired string, repaired_sha256 string, whole boolean")


def _repair_part(keep_text: bool):
    def repair(turns: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        """Repair one part; ``notes`` hold its duplicates and the ends of conversations that reach beyond it."""
        tables, out = _tables(), []
        beyond = {n["key"]: n for n in notes[notes["key"].notna()].to_dict("records")}
        part = int(turns["part"].iloc[0]) if len(turns) else 0
        for key, rows in _conversations(turns, notes):
            note = beyond.get(key)
            state, end, final = (0, LAST, True) if note is None else (int(note["start"]), tuple(map(int, note["end"])), bool(note["final"]))
            symbols = _symbols(rows)
            vector, total, trail = tables.back(symbols, tables.number[_normal(end)[0]])
            letters, behind = tables.walk(trail, state)
            cost = tables.vectors[vector][state] + total - (0 if final else end[behind])
            while final and letters and behind not in ACCEPTED:
                letters, behind = letters + "I", NEXT[behind]
            initials = rows["initial"].to_list()
            faults = [(b, not b and d, not b and not d and t) for b, d, t in zip(rows["blank"], rows["double"], rows["truncated"])]
            turn = rows["turn"][rows["numbered"]].to_list()
            lines = _lines(rows, letters, state)
            text = "\n".join(lines)
            out.append((key, part, len(rows), *(sum(map(int, column)) for column in (zip(*faults) if faults else [()] * 3)),
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                        initials[0] if initials else None, initials[-1] if initials else None,
                        min(turn, default=None), max(turn, default=None), len(set(turn)), cost, letters, len(lines),
                        text if keep_text or note is not None else None,
                        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), note is None))
        names = [c.split()[0] for c in PIECE.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"least": "Int64", "most": "Int64"})
    return repair


def _fold_part(turns: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    """Least costs through each conversation's turns of this part."""
    out = [(key, int(turns["part"].iloc[0]), _tables().through(_symbols(rows))) for key, rows in _conversations(turns, notes)] if len(turns) else []
    return pd.DataFrame(out, columns=["key", "part", "costs"])


def _chain_ends(parts: pd.DataFrame) -> pd.DataFrame:
    """The costs to the end behind each part of one conversation (one small row per part)."""
    parts = parts.sort_values("part", ascending=False)
    end, out = LAST, []
    for key, part, costs in zip(parts["key"], parts["part"], parts["costs"]):
        out.append((key, part, list(_normal(end)[0]), len(out) == 0))
        costs = np.asarray(costs, np.int64).reshape(4, 4)
        end = _with_inserts(tuple(min(NONE, int((costs[q] + np.array(end)).min())) for q in range(4)))
    return pd.DataFrame(out, columns=["key", "part", "end", "final"])


def _walk_part(turns: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    """Where each state before a part leads."""
    tables, out = _tables(), []
    ends = {n["key"]: n for n in notes[notes["key"].notna()].to_dict("records")}
    for key, rows in _conversations(turns, notes):
        end = tuple(map(int, ends[key]["end"]))
        _, _, trail = tables.back(_symbols(rows), tables.number[_normal(end)[0]])
        out.append((key, int(turns["part"].iloc[0]), [tables.walk(trail, q)[1] for q in range(4)], list(end), bool(ends[key]["final"])))
    return pd.DataFrame(out, columns=["key", "part", "leads", "end", "final"])


def _chain_starts(parts: pd.DataFrame) -> pd.DataFrame:
    state, starts = 0, []
    parts = parts.sort_values("part")
    for leads in parts["leads"]:
        starts.append(state)
        state = int(leads[state])
    return parts.assign(start=starts)[["key", "part", "start", "end", "final"]]


def _joined(parts: pd.DataFrame) -> pd.DataFrame:
    """One row from a conversation's parts (their numbers and letters, no texts)."""
    parts = parts.sort_values("part")
    illegal, turns, last, most = int(parts["illegal"].sum()), int(parts["turns"].sum()), None, None
    for row in parts.to_dict("records"):
        if row["n"]:
            illegal += last is not None and last + row["first"] not in ("su", "ua", "au")
            last = row["last"]
        if row["turns"]:
            turns -= most is not None and most == row["least"]
            most = row["most"]
    sums = {c: [int(parts[c].sum())] for c in ("n", "blank", "duplicate", "truncated")}
    return pd.DataFrame({"key": [parts["key"].iloc[0]], **sums, "illegal": [illegal],
                         "least": [parts["least"].min()], "most": [parts["most"].max()], "turns": [turns],
                         "cost": [int(parts["cost"].sum())], "audit": ["".join(parts["audit"])]}).astype({"least": "Int64", "most": "Int64"})


def _checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each conversation's parts in order; only the running state is held."""
    key, running, started = None, None, False
    for batch in batches:
        done = []
        for name, kept, text in zip(batch["key"], batch["kept"], batch["repaired"]):
            if name != key:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running, started = name, hashlib.sha256(), False
            if kept:
                running.update(((b"\n" if started else b"") + text.encode("utf-8", "surrogatepass")))
                started = True
        yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "repaired_sha256"])


def repaired_parts(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   present: Column | None = None, keep_text: bool = True, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per conversation and part (nearly all lie in one part): counts, cost, audit, repaired text."""
    tune(turns.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("key"),
        F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        F.monotonically_increasing_id().alias("row"))
    count, size = plain.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, math.ceil(count / part_rows), math.ceil((size or 0) / PART_BYTES))
    order = [F.col("key"), F.col("turn").asc_nulls_first(), "role", "text", "row"]
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    ordered = staged(plain.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("part"), "key", "present",
        F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("numbered"), "role", "text",
        F.substring("role", 1, 1).alias("initial"), (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)).alias("digest")), "turns")

    # A turn is a duplicate if an earlier one of its conversation has its role and text.
    narrow = ordered.where("present").select("key", "digest", "pos", "part")
    first = narrow.groupBy("key", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    doubles = staged(narrow.join(first, ["key", "digest"]).where("pos > first").select("part", "pos"), "doubles")
    notes = doubles.select("part", "pos", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("key", "string"), ("start", "int"), ("end", "array<long>"), ("final", "boolean"))])

    # Conversations that lie in several parts: at most one begins in each part.
    far = staged(ordered.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("key"), "far")
    if parts > 1 and far.head(1):
        lean = ordered.drop("text", "role", "digest").join(far, "key").groupBy("part")
        costs = staged(lean.cogroup(notes.groupBy("part")).applyInPandas(_fold_part, "key string, part int, costs array<long>"), "costs")
        ends = staged(costs.groupBy("key").applyInPandas(_chain_ends, "key string, part int, end array<long>, final boolean"), "ends")
        known = notes.unionByName(ends, allowMissingColumns=True)
        leads = staged(lean.cogroup(known.groupBy("part")).applyInPandas(
            _walk_part, "key string, part int, leads array<int>, end array<long>, final boolean"), "leads")
        starts = staged(leads.groupBy("key").applyInPandas(
            _chain_starts, "key string, part int, start int, end array<long>, final boolean"), "starts")
        notes = notes.unionByName(starts, allowMissingColumns=True)
    return staged(ordered.drop("digest").groupBy("part").cogroup(notes.groupBy("part"))
                  .applyInPandas(_repair_part(keep_text), PIECE), "repaired")


def repaired(turns: DataFrame, key: str = "conv_id", **options) -> DataFrame:
    """One row per conversation: key, n, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    pieces = repaired_parts(turns, key, **{"keep_text": False, **options})
    columns = ["key", "n", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns", "cost", "audit"]
    several = pieces.where("not whole")
    joined = several.drop("repaired").groupBy("key").applyInPandas(
        _joined, "key string, n long, blank long, duplicate long, truncated long, illegal long, least long, most long, "
                 "turns long, cost long, audit string")
    sums = several.select("key", "part", "kept", "repaired").repartition("key").sortWithinPartitions("key", "part") \
        .select("key", "kept", "repaired").mapInPandas(_checksums, "key string, repaired_sha256 string")
    every = pieces.where("whole").select(*columns, "repaired_sha256").union(joined.select(columns).join(sums, "key"))
    return every.select(
        F.when(F.col("key") == "null", None).otherwise(F.expr("substring(key, 2)")).cast(turns.schema[key].dataType).alias(key), "n",
        F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns and ``present``, with faults by the checksum of ``key:turn``, for tests of repair at scale."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.encode(F.concat(part(key), F.lit(":"), part(turn)), "UTF-8")), F.lit(20))
    hurt = turns.select(F.col(key).alias(key), F.col(turn).alias(turn), part(role).alias(role), part(text).alias(text), fault.alias("fault"))
    return hurt.select(
        key, turn, F.when(F.col("fault") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(F.col(text), ".!?", "")).otherwise(F.col(text)).alias(text),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
