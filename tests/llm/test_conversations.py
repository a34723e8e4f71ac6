"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from mvtax.llm import conversations, queries

sys.setrecursionlimit(20_000)  # the search goes down an edit at a time
NOTHING = hashlib.sha256(b"").hexdigest()


def allowed(roles: str) -> bool:
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Least (cost, edits) of all edit strings with at most three insertions in a row, by trying them."""
    seen, faults = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("gone" if not body or (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i: int, last: str, grown: int):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))

        def follow(cost, letter, at, roles, row, more):
            if not (last, roles) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                return
            rest = best(at, roles, more)
            if rest:
                options.append((cost + rest[0], letter + rest[1], (row,) + rest[2]))

        if grown < 3:
            for role in ("user", "assistant"):
                follow(2, "I", i, role[0], (role, ""), grown + 1)
        if i < len(rows):
            role, text = rows[i]
            rest = best(i + 1, last, 0)
            if rest:
                options.append((3 + rest[0], "D" + rest[1], rest[2]))
            if faults[i] != "gone":
                cut = int(faults[i] == "cut")
                follow(cut, "K", i + 1, role[:1], (role, text), 0)
                for new in ("user", "assistant"):
                    follow(2 + cut, "R", i + 1, new[0], (new, text), 0)
        return min(options, key=lambda o: o[:2]) if options else None

    cost, audit, kept = best(0, "", 0)
    assert allowed("".join(r[:1] for r, _ in kept))
    return cost, audit, list(kept)


def expected(rows):
    """Results of one conversation, from its rows ``(turn, role, text)``."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    blank = duplicate = truncated = illegal = 0
    seen = set()
    for k, (_, role, text) in enumerate(rows):
        body = text.encode().rstrip()
        if not body:
            blank += 1
        elif (role, text) in seen:
            duplicate += 1
        elif body[-1:] not in b".!?":
            truncated += 1
        seen.add((role, text))
        illegal += k > 0 and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    cost, audit, kept = cheapest([(r, x) for _, r, x in rows])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, blank, duplicate, truncated, illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest(), kept)


def conversation(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", "unknown", "", None], ["Yes.", "No", "What?", "", " \n", "été!", None, "x" * 50]
    turn, out = 0, []
    for _ in range(n):
        turn += rng.choice([0, 1, 1, 1, 2])
        out.append((None if rng.random() < 0.1 else turn, rng.choice(roles[:2] * 6 + roles), rng.choice(texts) if rng.random() < 0.5 else f"Line {rng.randrange(30)}."))
    return out


@pytest.mark.parametrize("block", [2, 7, 1024])
def test_repair_is_the_cheapest_and_ascii_least(spark, block):
    rng = random.Random(block)
    data = {c: conversation(rng, rng.choice([1, 2, 3, 5, 8, 40])) for c in [None, 2**60 + 1, *range(25)]}
    data[30] = conversation(rng, 300)
    rows = [(c, *r, "extra", 1, "x") for c, rs in data.items() for r in rs]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rows string, pid int, audit string").repartition(3)
    got = {r["conv_id"]: r for r in conversations.repair(table, block).collect()}
    assert set(got) == set(data)
    turns = {}
    for r in conversations.repaired_turns(table, block).collect():
        turns.setdefault(r["conv_id"], []).append((tuple(r["place"]), r["role"], r["text"]))
    for c, rs in data.items():
        want = expected(rs)
        assert tuple(got[c][n] for n in conversations.RESULTS) == want[:8], (c, rs)
        assert [(a, b) for _, a, b in sorted(turns.get(c, []))] == want[8]


def test_one_row_repeated_and_empty_tables(spark):
    same = [(1, 3, "user", "Yes.")] * 500 + [(1, None, "assistant", "No.")] * 3
    got = conversations.repair(spark.createDataFrame(same, "conv_id long, turn long, role string, text string"), 16).collect()
    assert len(got) == 1 and got[0]["duplicate"] == 501 and tuple(got[0][n] for n in conversations.RESULTS) == expected([r[1:] for r in same])[:8]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(empty).collect() == [] and conversations.repair(conversations.damage(empty)).collect() == []


def test_damage_and_the_query(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    data = {}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{c}:{turn}".encode()) % 20
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        data.setdefault(c, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    got = {r["conv_id"]: tuple(r[n] for n in conversations.RESULTS) for r in queries.op11_conversations(spark, "/root/testdata/sf0.001").collect()}
    assert got == {c: expected(rs)[:8] for c, rs in data.items()}


def test_a_conversation_whose_rows_all_go_is_reported(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f" :{t}".encode()) % 20 == 0)
    table = spark.createDataFrame([(None, gone, None, None)], "conv_id long, turn long, role string, text string")
    got = conversations.repair(conversations.damage(table)).collect()
    assert [tuple(r) for r in got] == [(None, 0, 0, 0, 0, 0, 0, "", NOTHING)]
