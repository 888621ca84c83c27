import hashlib
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import conversation_repair as C
from ledgerlens.llm import queries as Q

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def by_tables(rows):
    """Brute force: the least (cost, edits) for every prefix and last role, by plain dynamic programming."""
    best = {0: (0, "")}
    asked = "uuau"
    def with_inserts(b):
        for _ in range(3):
            for last, (cost, e) in list(b.items()):
                to = {"u": 2, "a": 3}[asked[last]]
                b[to] = min(b.get(to, (1 << 30, "")), (cost + 2, e + "I"))
        return b
    best = with_inserts(best)
    for c in rows:
        after = {}
        def put(last, cost, e):
            after[last] = min(after.get(last, (1 << 30, "")), (cost, e))
        for last, (cost, e) in best.items():
            put(last, cost + 3, e + "D")
            if c != "x":
                stays, r = int(c.isupper()), c.lower()
                put({"u": 2, "a": 3}[asked[last]], cost + 2 + stays, e + "R")
                if r == asked[last] or (r == "s" and last == 0):
                    put({"s": 1, "u": 2, "a": 3}[r], cost + stays, e + "K")
        best = with_inserts(after)
    return min(best[k] for k in (0, 3) if k in best)


def test_every_short_transcript():
    for n in range(5):
        for rows in product("suaoUAx", repeat=n):
            rows = "".join(rows)
            assert C.cheapest_edits(rows) == by_tables(rows), rows


@settings(max_examples=200, deadline=None)
@given(st.text("ssuuuaaaoSUAOx", max_size=60))
def test_long_transcripts(rows):
    assert C.cheapest_edits(rows) == by_tables(rows)


def test_very_long_transcript():
    rows = ("uaUaxuuaaoaua" * 8000)[:100_000]
    cost, edits = C.cheapest_edits(rows)
    assert (cost, edits) == by_tables_linear(rows)


def by_tables_linear(rows):
    """The same tables with links instead of strings, compared from the end backwards."""
    inf = 1 << 60
    asked, accept = "uuau", (0, 3)
    n = len(rows)
    ahead = [inf] * 4
    for last in accept:
        ahead[last] = 0
    tables = [None] * (n + 1)
    for i in range(n, -1, -1):
        here = list(ahead) if i == n else [min(
            [ahead_next[last] + 3] + ([] if rows[i] == "x" else [
                ahead_next[{"u": 2, "a": 3}[asked[last]]] + 2 + rows[i].isupper(),
                *([ahead_next[{"s": 1, "u": 2, "a": 3}[rows[i].lower()]] + rows[i].isupper()]
                  if rows[i].lower() == asked[last] or (rows[i].lower() == "s" and last == 0) else [])])) for last in range(4)]
        for _ in range(3):
            here = [min(here[last], here[{"u": 2, "a": 3}[asked[last]]] + 2) for last in range(4)]
        tables[i] = ahead_next = here
    out, i, last = [], 0, 0
    while not (i == n and last in accept):
        left = tables[i][last]
        for e, cost, used, to in C._MOVES[rows[i:i + 1], last]:
            if cost + tables[i + used][to] == left:
                out.append(e)
                i, last = i + used, to
                break
    return tables[0][0], "".join(out)


def by_hand(rows):
    """The whole contract in plain Python over (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        convs.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = {}
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks, n = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rs:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            i = role[:1] if role[:1] in ("s", "u", "a") else "o"
            marks += "x" if fault in ("blank", "duplicate") else i.upper() if fault else i
        cost, edits = by_tables(marks)
        turns = {t for t, _, _ in rs if t is not None}
        left, lines, last = iter(rs), [], 0
        for e in edits:
            role, text = ("", "") if e == "I" else next(left)[1:]
            if e == "D":
                continue
            if e in "IR":
                role = {"u": "user", "a": "assistant"}["uuau"[last]]
            last = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        out[conv] = {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **n,
                     "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:])), "cost": cost, "audit": edits,
                     "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


@pytest.fixture
def turns_of(spark):
    schema = "conv_id long, turn long, role string, text string, kind string, mark int, place string, dropped_by string, header string, copy int"
    return lambda rows: spark.createDataFrame([(*r, "clash", 3, "p", "q", "{}", 9) for r in rows], schema)


def of_query(turns):
    damaged = C.damage(turns)
    return {r["conv_id"]: r.asDict() for r in C.repaired_digests(damaged, C.audit(damaged)).collect()}


def test_whole_contract_on_odd_rows(turns_of):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {c % 3} {t}" + [".", "", "! ", "?\t\n", "\u0085"][(c + t) % 5]) for c in range(60) for t in range(c % 12)]
    rows += [(70, None, "user", "no turn."), (70, None, None, None), (70, 3, "", "empty role."), (70, 3, "", "empty role."), (70, 9, "tool", "x."), (70, 9, "tool", "a."),
             (None, 1, "user", "null id."), (None, None, "assistant", "Same."), (None, 2, "system", "late system."), (71, 1 << 40, "user", "far."), (71, 0, "User", "near."),
             (72, 0, "user", "long. " * 200_000), (72, 1, "assistant", " "), (73, 0, "assistant", "é.\r\n"), (73, 1, "user", "."), ((1 << 53) + 1, 0, "user", "big id.")]
    rows += [(90, t, ["user", "assistant", "system", "tool"][t * 7 % 11 % 4], f"w{t % 90}.") for t in range(700)]
    assert of_query(turns_of(rows)) == by_hand(rows)


def test_all_rows_dropped_and_empty_table(turns_of):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = of_query(turns_of([(gone, 0, "user", "x.")]))
    assert got == {gone: {"conv_id": gone, **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "",
                          "repaired_sha256": hashlib.sha256(b"").hexdigest()}}
    assert of_query(turns_of([])) == {}


def test_repaired_rows(turns_of):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hello?"), (1, 3, "assistant", "Yes."), (1, 4, "assistant", " ")]
    got = C.repair(turns_of(rows)).orderBy("place").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in got] == [
        ("K", "system", "Be kind."), ("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Hello?"), ("K", "assistant", "Yes.")]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    got = {r["conv_id"]: r.asDict() for r in Q.op11_conversation_repair(spark, sf).collect()}
    assert got == by_hand([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns])
