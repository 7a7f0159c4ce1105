"""Chat formatting with minimum-cost repair of roles.

A conversation's turns must follow an automaton: an optional system turn, then user and assistant
turns in alternation, the user first. Repairs cost: joining a turn to the one before (MERGE), giving
it another role (RELABEL), putting an empty turn before it (INSERT). Dynamic programming over the
automaton's states (the last role) finds the cheapest repair. Among repairs of equal cost the first
turn at which they differ decides: there the turn's own role goes before another, then turn before
merge before insert, then system before user before assistant, for the turn and then for the
inserted one. So there is one repair, wherever a conversation is cut. The repaired turns are rendered.

Each turn gives one row with its piece of the rendering, so that the pieces of a conversation in
order are its whole text: a conversation of any length needs no place where all of it is held.

A conversation is cut into blocks of at most BLOCK_TURNS turns. A block's costs from each state to
each state are a 4 x 4 matrix, and a second one ranks, from each state, the best paths to the four
states in the order of preference. Both chain: of two paths that meet, the cheaper goes on, or that of
the lower rank before the block. A conversation of several blocks is first solved on its matrices
(256 bytes a block), which fixes the states at each block's ends, and blocks are then solved alone.
Rows are dealt by ranges of (conversation, turn), so one conversation may fill many tasks.

Defined results: turns are ordered by turn (nulls last), role and text; equal rows keep their number;
a null conv_id is a conversation of its own; a null or unknown role has to be relabelled; a null text
is empty; a very long text is a block of its own; the marks <| of the template become < | in texts;
further columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

ROLES = ("system", "user", "assistant")
START = 0
#: What each state (0 at the start, then the last role) may be followed by.
FOLLOWS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
#: The states in which a conversation may end.
ENDS = (2, 3)
MERGE, RELABEL, INSERT = 1.0, 2.0, 3.0
BLOCK_TURNS = 4096
BLOCK_CHARS = 4 << 20
_INF = float("inf")


def _arcs() -> list[tuple[int, int, float, str, int]]:
    """(from, to, cost, action, inserted role): how a turn of role `to` may come after a state."""
    arcs = []
    for state, nexts in FOLLOWS.items():
        arcs += [(state, role, 0.0, "turn", 0) for role in nexts]
        if state:
            arcs.append((state, state, MERGE, "merge", 0))
        for empty in nexts:
            arcs += [
                (state, role, INSERT, "insert", empty)
                for role in FOLLOWS[empty]
                if role not in nexts
            ]
    best: dict[tuple[int, int, str], tuple[int, int, float, str, int]] = {}
    for arc in sorted(arcs, key=lambda a: (a[2], a[4])):
        best.setdefault((arc[0], arc[1], arc[3]), arc)
    return list(best.values())


ARCS = _arcs()


def role_number(role: str | None) -> int:
    return ROLES.index(role) + 1 if role in ROLES else 0


ACTIONS = ("turn", "merge", "insert")


def preferred(role: int) -> list[tuple[int, int, float, str, int]]:
    """The arcs for a turn of a role, with the whole price, in the order of preference."""
    order = sorted(ARCS, key=lambda a: (a[1] != role, ACTIONS.index(a[3]), a[1], a[4], a[0]))
    return [
        (state, to, price + (RELABEL if role != to else 0.0), action, empty)
        for state, to, price, action, empty in order
    ]


CHOICES = [preferred(role) for role in range(4)]

#: The best path to each state: its cost (infinite: none) and its rank among the four.
Paths = tuple[tuple[float, int], ...]


def started(entry: int) -> Paths:
    return tuple((0.0 if state == entry else _INF, 0) for state in range(4))


@lru_cache(maxsize=4096)
def advanced(paths: Paths, role: int) -> tuple[Paths, float, tuple]:
    """One turn on: the paths less their least cost, that cost, and by state (state before, action,
    inserted role). Costs are relative, so few different paths exist and results are kept."""
    best: dict[int, tuple] = {}
    for place, (state, to, price, action, empty) in enumerate(CHOICES[role]):
        cost, rank = paths[state]
        found = (cost + price, rank, place, (state, action, empty))
        if cost < _INF and (to not in best or found[:3] < best[to][:3]):
            best[to] = found
    ranks = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
    least = min(found[0] for found in best.values())
    new = tuple((best[s][0] - least, ranks[s]) if s in best else (_INF, 0) for s in range(4))
    return new, least, tuple(best[s][3] if s in best else None for s in range(4))


def block_paths(roles: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Costs from each state to each state over a block, and the ranks of each state's paths."""
    costs, ranks = np.full((4, 4), _INF), np.zeros((4, 4), np.int64)
    for entry in range(4):
        paths, base = started(entry), 0.0
        for role in roles:
            paths, least, _ = advanced(paths, role)
            base += least
        costs[entry] = [base + cost for cost, _ in paths]
        ranks[entry] = [rank for _, rank in paths]
    return costs, ranks


def best_end(paths: Paths) -> int:
    """The state in which the best whole path ends."""
    return min(ENDS, key=lambda state: paths[state])


def chained(blocks: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """(entry, leave) of each block of a conversation, out of the blocks' matrices."""
    paths, back = started(START), []
    for costs, ranks in blocks:
        new, how = [], []
        for to in range(4):
            choices = [(paths[s][0] + costs[s, to], paths[s][1], s) for s in range(4)]
            cost, rank, state = min(choices)
            new.append((cost, (rank, ranks[state, to])))
            how.append(state)
        reached = [to for to in range(4) if new[to][0] < _INF]
        place = {to: i for i, to in enumerate(sorted(reached, key=lambda to: new[to][1]))}
        paths = tuple((new[to][0], place.get(to, 0)) for to in range(4))
        back.append(how)
    leave = best_end(paths)
    out = []
    for how in reversed(back):
        out.append((how[leave], leave))
        leave = how[leave]
    return out[::-1]


def solved(roles: list[int], entry: int, leave: int | None) -> list[tuple[int, str, int]]:
    """(role, action, inserted role) for each turn, from a state to a state (None: any end)."""
    paths = started(entry)
    back = []
    for role in roles:
        paths, _, how = advanced(paths, role)
        back.append(how)
    if leave is None:
        leave = best_end(paths)
    out = []
    for how in reversed(back):
        state, action, empty = how[leave]
        out.append((leave, action, empty))
        leave = state
    return out[::-1]


def rendered(text: str, state: int, role: int, action: str, empty: int, last: bool) -> str:
    """A turn's piece of the text: what closes the turn before, the turn, the end."""
    text = text.replace("<|", "< |")
    if action == "merge":
        piece = f"\n\n{text}"
    else:
        piece = "<|im_end|>\n" if state else ""
        if action == "insert":
            piece += f"<|im_start|>{ROLES[empty - 1]}\n<|im_end|>\n"
        piece += f"<|im_start|>{ROLES[role - 1]}\n{text}"
    return piece + ("<|im_end|>\n" if last else "")


_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_BLOCK = (
    "conv_id long, part int, block int, costs array<double>, ranks array<long>,"
    " turns array<struct<turn:long,role:string,text:string>>"
)


def packed(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Blocks of turns in order: conv_id, part and block (their order), costs, ranks, turns."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [
        F.col("conv_id").asc_nulls_last(),
        F.col("turn").asc_nulls_last(),
        F.col("role").asc_nulls_last(),
        F.col("text").asc_nulls_last(),
    ]
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    dealt = rows.repartitionByRange(parts, *order[:3], F.xxhash64("text").asc())
    dealt = dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, block, chars = None, 0, 0, 0
        held: list[dict] = []
        out: list[tuple] = []

        def close() -> None:
            roles = [role_number(turn["role"]) for turn in held]
            matrices = [matrix.ravel().tolist() for matrix in block_paths(roles)]
            out.append((conv, part, block, *matrices, list(held)))

        def written() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            numbers = (pa.list_(pa.float64()), pa.list_(pa.int64()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), *numbers, pa.list_(_TURN))
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            names = ["conv_id", "part", "block", "costs", "ranks", "turns"]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for row in batch.to_pylist():
                size = len(row["text"] or "")
                full = len(held) >= block_turns or (held and chars + size > BLOCK_CHARS)
                if held and (row["conv_id"] != conv or full):
                    close()
                    block = block + 1 if row["conv_id"] == conv else 0
                    held, chars = [], 0
                    if len(out) >= 256:
                        yield written()
                conv, part = row["conv_id"], row["part"]
                held.append({k: row[k] for k in ("turn", "role", "text")})
                chars += size
            if sum(len(o[5]) for o in out) >= BLOCK_TURNS:
                yield written()
        if held:
            close()
        if out:
            yield written()

    return dealt.mapInArrow(run, _BLOCK)


def ends(blocks: DataFrame) -> DataFrame:
    """conv_id, part, block, entry, leave, last, before (turns in earlier ones) of the blocks of conversations that have several."""

    def chain(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(["part", "block"], kind="stable")
        matrices = [
            (np.array(costs, dtype=float).reshape(4, 4), np.array(ranks, dtype=int).reshape(4, 4))
            for costs, ranks in zip(blocks["costs"], blocks["ranks"], strict=True)
        ]
        states = chained(matrices)
        done = blocks[["conv_id", "part", "block"]].copy()
        done["entry"], done["leave"] = zip(*states, strict=True)
        done["before"] = blocks["held"].cumsum() - blocks["held"]
        done["last"] = [False] * (len(done) - 1) + [True]
        return done

    held = F.size("turns").cast("long").alias("held")
    several = blocks.select("conv_id", "part", "block", "costs", "ranks", held).withColumn(
        "n", F.count("*").over(Window.partitionBy("conv_id"))
    )
    return (
        several.where("n > 1")
        .drop("n")
        .groupBy("conv_id")
        .applyInPandas(
            chain,
            "conv_id long, part int, block int, entry int, leave int, before long, last boolean",
        )
    )


def format_chats(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a turn: conv_id, position (running number in the conversation, from 0: in this order its
    pieces are its text), part, block, place (where it was handled, in the same order), turn, role, new_role, action (turn, merge, insert), inserted, rendered."""
    blocks = stage(packed(turns, block_turns), "turns")
    known = ends(blocks)
    joined = blocks.join(
        known.withColumnRenamed("conv_id", "of"),
        blocks["conv_id"].eqNullSafe(F.col("of"))
        & (blocks["part"] == known["part"])
        & (blocks["block"] == known["block"]),
        "left",
    ).select(
        blocks["conv_id"], blocks["part"], blocks["block"], "turns", "entry", "leave", "before", "last"
    )
    fields = (
        ("conv_id", pa.int64()),
        ("position", pa.int64()),
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("place", pa.int32()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("new_role", pa.string()),
        ("action", pa.string()),
        ("inserted", pa.string()),
        ("rendered", pa.string()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(start, 64).to_pylist():
                    roles = [role_number(turn["role"]) for turn in row["turns"]]
                    entry = row["entry"] or START
                    state, whole = entry, row["leave"] is None
                    for i, (turn, (role, action, empty)) in enumerate(
                        zip(row["turns"], solved(roles, entry, row["leave"]), strict=True)
                    ):
                        last = i == len(roles) - 1 and (whole or bool(row["last"]))
                        piece = rendered(turn["text"] or "", state, role, action, empty, last)
                        out.append(
                            (
                                row["conv_id"], (row["before"] or 0) + i, row["part"], row["block"],
                                i, turn["turn"], turn["role"], ROLES[role - 1], action,
                                ROLES[empty - 1] if empty else None, piece,
                            )
                        )
                        state = role
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)],
                    [name for name, _ in fields],
                )

    return joined.mapInArrow(
        run,
        "conv_id long, position long, part int, block int, place int, turn long, role string,"
        " new_role string, action string, inserted string, rendered string",
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op9: every turn of every conversation, repaired and rendered, with its place in the text."""
    return format_chats(table(spark, folder, "conversations")).drop("part", "block", "place")


#: The arcs in the order of preference, by role (0: unknown), as SQL rows.
_CHOICES = ", ".join(
    f"({role}, {place}, {state}, {to}, {int(price)}, '{action}', {empty})"
    for role, choices in enumerate(CHOICES)
    for place, (state, to, price, action, empty) in enumerate(choices)
)

#: All paths that are best for their state go on turn by turn, each with the choices it took, a letter
#: a turn; of equal cost, the path whose letters sort first.
ORACLE = f"""
WITH RECURSIVE arcs(role, place, state, new_state, price, action, inserted) AS (VALUES {_CHOICES}),
turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST,
      text NULLS LAST) - 1 AS position, count(*) OVER (PARTITION BY conv_id) AS n,
    coalesce(list_position({list(ROLES)}, role), 0) AS r FROM conversations),
paths(conv_id, position, state, cost, letters) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0::BIGINT, '' FROM turns
  UNION ALL
  SELECT p.conv_id, p.position + 1, a.new_state, p.cost + a.price, p.letters || chr(97 + a.place)
  FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.position = p.position
  JOIN arcs a ON a.role = t.r AND a.state = p.state
  QUALIFY row_number() OVER (PARTITION BY p.conv_id, a.new_state
    ORDER BY p.cost + a.price, p.letters || chr(97 + a.place)) = 1),
best AS (
  SELECT p.conv_id, p.letters FROM paths p
  JOIN (SELECT DISTINCT conv_id, n FROM turns) t
    ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.n = p.position
  WHERE p.state IN {ENDS}
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost, p.letters) = 1),
steps AS (
  SELECT t.*, a.state, a.new_state, a.action, a.inserted AS empty,
    {list(ROLES)} AS names, replace(t.text, '<|', '< |') AS shown
  FROM turns t JOIN best b ON b.conv_id IS NOT DISTINCT FROM t.conv_id
  JOIN arcs a ON a.role = t.r AND a.place = ascii(b.letters[t.position + 1]) - 97)
SELECT conv_id, position, turn, role, names[new_state] AS new_role, action,
  CASE WHEN empty > 0 THEN names[empty] END AS inserted,
  CASE WHEN action = 'merge' THEN chr(10) || chr(10) || shown ELSE
    CASE WHEN state > 0 THEN '<|im_end|>' || chr(10) ELSE '' END
    || CASE WHEN action = 'insert'
      THEN '<|im_start|>' || names[empty] || chr(10) || '<|im_end|>' || chr(10) ELSE '' END
    || '<|im_start|>' || names[new_state] || chr(10) || shown END
  || CASE WHEN position = n - 1 THEN '<|im_end|>' || chr(10) ELSE '' END AS rendered
FROM steps
"""
