import random
from itertools import product

import duckdb

from gleaner.llm import chat as C


def brute(roles):
    """Least cost over all choices, by trying every one."""
    best = {0: 0.0}
    for role in roles:
        new = {}
        for state, cost in best.items():
            for to in (1, 2, 3):
                change = C.RELABEL if role != to else 0.0
                ways = []
                if to in C.FOLLOWS[state]:
                    ways.append(0.0)
                if state == to:
                    ways.append(C.MERGE)
                ways += [C.INSERT for empty in C.FOLLOWS[state] if to in C.FOLLOWS[empty]]
                for way in ways:
                    new[to] = min(new.get(to, 1e9), cost + change + way)
        best = new
    return min(best[s] for s in C.ENDS if s in best)


def cost_of(roles, steps):
    total, state = 0.0, 0
    for role, (to, action, empty) in zip(roles, steps, strict=True):
        total += C.RELABEL if role != to else 0.0
        if action == "merge":
            assert state == to
            total += C.MERGE
        elif action == "insert":
            assert empty in C.FOLLOWS[state] and to in C.FOLLOWS[empty]
            total += C.INSERT
        else:
            assert to in C.FOLLOWS[state]
        state = to
    assert state in C.ENDS
    return total


def test_repairs_are_cheapest():
    for size in range(1, 6):
        for roles in product(range(4), repeat=size):
            steps = C.solved(list(roles), C.START, None)
            assert cost_of(roles, steps) == brute(roles)
            cost, _ = C.block_paths(list(roles))
            assert min(cost[C.START, s] for s in C.ENDS) == brute(roles)


def every_repair(roles):
    """(cost, preferences) and steps of all legal repairs, by trying every one."""
    found = [(0.0, (), (), C.START)]
    for role in roles:
        found = [
            (cost + price + (C.RELABEL if role != to else 0.0),
             (*taste, (role != to, C.ACTIONS.index(action), to, empty)), (*steps, (to, action, empty)), to)
            for cost, taste, steps, last in found
            for state, to, price, action, empty in C.ARCS
            if state == last
        ]
    return [(cost, taste, steps) for cost, taste, steps, last in found if last in C.ENDS]


def test_ties_are_settled_by_the_first_turn_that_differs():
    for size in range(1, 5):
        for roles in product(range(4), repeat=size):
            assert tuple(C.solved(list(roles), C.START, None)) == min(every_repair(roles))[2]


def test_repairs_do_not_depend_on_cuts():
    for size in range(2, 7):
        for roles in product(range(4), repeat=size):
            whole = C.solved(list(roles), C.START, None)
            for cuts in range(1, 1 << (size - 1)):
                at = [0, *(i + 1 for i in range(size - 1) if cuts >> i & 1), size]
                parts = [list(roles[a:b]) for a, b in zip(at, at[1:])]
                states = C.chained([C.block_paths(part) for part in parts])
                steps = [C.solved(part, *ends) for part, ends in zip(parts, states, strict=True)]
                assert sum(steps, []) == whole


SCHEMA = "conv_id long, turn long, role string, text string"


def test_blocks_chain_to_the_same_cost(spark):
    rng = random.Random(4)
    names = [*C.ROLES, None, "tool"]
    rows = [(c, t, rng.choice(names), f"{c}-{t}") for c in range(6) for t in range(rng.randint(1, 40))]
    rows += [(99, t, rng.choice(names), str(t)) for t in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS block").repartition(5)
    seen = []
    for block in (3, 4096):
        found = C.format_chats(df, block).orderBy("conv_id", "part", "block", "place").collect()
        assert len(found) == len(rows)
        seen.append([(r.conv_id, r.position, r.turn, r.new_role, r.action, r.rendered) for r in found])
        for conv in {r[0] for r in rows}:
            own = [r for r in found if r.conv_id == conv]
            assert [r.turn for r in own] == list(range(len(own)))
            roles = [C.role_number(r.role) for r in own]
            steps = [
                (C.role_number(r.new_role), r.action, C.role_number(r.inserted)) for r in own
            ]
            assert cost_of(roles, steps) == brute(roles)
            text = "".join(r.rendered for r in own)
            assert text.count("<|im_start|>") == text.count("<|im_end|>")
    assert seen[0] == seen[1]


def test_against_sql(spark, tmp_path):
    rng = random.Random(9)
    names = [*C.ROLES, None, "tool"]
    rows = [(c or None, rng.choice([None, t]), rng.choice(names), rng.choice([None, f"<|{t}"]))
            for c in range(60) for t in range(rng.randint(1, 12))]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = C.query(spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
        want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({C.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_legal_conversations_stay_and_edges(spark):
    legal = [(1, 0, "system", "s"), (1, 1, "user", "u <|x"), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(legal, SCHEMA)
    got = C.format_chats(df).orderBy("part", "block", "place").collect()
    assert all(r.action == "turn" and r.role == r.new_role for r in got)
    assert "".join(r.rendered for r in got) == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu < |x<|im_end|>\n"
        "<|im_start|>assistant\na<|im_end|>\n"
    )
    odd = [(None, None, None, None), (None, None, None, None), (2, 0, "assistant", None)]
    assert C.format_chats(spark.createDataFrame(odd, SCHEMA)).count() == 3
    assert C.format_chats(df.limit(0)).count() == 0


def test_query_gives_the_order_of_pieces(spark, tmp_path):
    turns = [(1, t, r, x) for t, r, x in ((None, "user", "b"), (None, "user", "a"), (3, "assistant", "c"),
                                          (3, "assistant", "d"), (1, "system", "e"), (2, "user", "f"))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = C.query(spark, str(tmp_path)).collect()
    assert sorted(r.position for r in rows) == list(range(6))
    text = "".join(r.rendered for r in sorted(rows, key=lambda r: r.position))
    places = [text.index(x) for x in ("\ne", "\nf", "\nc", "\nd", "\na", "\nb")]
    assert places == sorted(places)


def test_positions_run_over_blocks(spark):
    rows = [(c, None, "user", f"{t:02}") for c in (1, None) for t in range(20)]
    got = C.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(5), 3).collect()
    for conv in (1, None):
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: (r.part, r.block, r.place))
        assert [r.position for r in own] == list(range(20))
