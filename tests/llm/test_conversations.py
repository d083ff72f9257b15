"""Auction paths against all edits of short conversations and against dynamic programming; the whole report against plain Python."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from innflow.llm import conversations as C

SPACE = " \t\n\x0b\x0c\r"


def every(rows):
    """All edit strings of a short conversation, by brute force."""
    found = {}
    n = len(rows)

    def walk(k, initials, audit, cost, out, inserted):
        if cost > 3 * n:
            return
        if k == n and re.fullmatch(r"(s?(ua)+)?", initials):
            key = (cost, audit)
            if key not in found:
                found[key] = out
        if inserted < 4:
            for r in ("user", "assistant"):
                if initials[-1:] != r[0]:
                    walk(k, initials + r[0], audit + "I", cost + 2, (*out, (r, "")), inserted + 1)
        if k == n:
            return
        role, text, fault = rows[k]
        walk(k + 1, initials, audit + "D", cost + 3, out, inserted)
        if fault in ("blank", "duplicate"):
            return
        extra = fault == "truncated"
        if role[:1]:
            walk(k + 1, initials + role[0], audit + "K", cost + extra, (*out, (role, text)), inserted)
        for r in ("user", "assistant"):
            walk(k + 1, initials + r[0], audit + "R", cost + 2 + extra, (*out, (r, text)), inserted)

    walk(0, "", "", 0, (), 0)
    (cost, audit) = min(found)
    return cost, audit, found[(cost, audit)]


def by_sets(rows):
    """Least cost and string for long ones: backward dynamic programming, strings of equal cost compared."""
    needed = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
    after = {s: ((0, "") if s in (0, 3) else (10 ** 9, "")) for s in range(4)}

    def insertions(now):
        for _ in range(3):
            now = {s: min(now[s], (now[needed[s][0]][0] + 2, "I" + now[needed[s][0]][1])) for s in now}
        return now

    after = insertions(after)
    for role, _, fault in reversed(rows):
        now = {}
        for s in range(4):
            options = [(after[s][0] + 3, "D" + after[s][1])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                to = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
                if to is not None:
                    options.append((after[to][0] + extra, "K" + after[to][1]))
                t = needed[s][0]
                options.append((after[t][0] + 2 + extra, "R" + after[t][1]))
            now[s] = min(options)
        after = insertions(now)
    return after[0]


FAULTS = {None: C.FINE, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}


def codes(rows):
    return bytes(FAULTS[f] | C.INITIALS.get(r[:1], 0) for r, _, f in rows)


def test_short_conversations_by_all_edits():
    rng = random.Random(5)
    cases = [[]] + [[(r, f"t{r}", f)] for r, f in product(["system", "user", "assistant", "tool", ""], FAULTS)]
    cases += [[(rng.choice(["system", "user", "assistant", "assistant", "tool", ""]), f"t{i}", rng.choice([None, None, None, *FAULTS])) for i in range(rng.randint(2, 4))]
              for _ in range(150)]
    for rows in cases:
        cost, audit, out = every(rows)
        assert C.cheapest(codes(rows)) == (cost, audit), rows
        assert tuple(C.repaired(audit, [(r, t) for r, t, _ in rows])) == out
        assert by_sets(rows) == (cost, audit)


def test_long_conversations_in_segments(monkeypatch):
    rng = random.Random(6)
    for size in (31, 32, 33, 64, 200, 700):
        for _ in range(4):
            rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "x"]), "t", rng.choice([None] * 5 + [*FAULTS])) for _ in range(size)]
            want = by_sets(rows)
            assert C.cheapest(codes(rows)) == want
            monkeypatch.setattr(C, "SEGMENT", 7)
            assert C.cheapest(codes(rows)) == want
            monkeypatch.undo()


def test_prices_are_a_dual_solution():
    rows = [("user", "t", None), ("user", "t", "truncated"), ("system", "t", None), ("assistant", "t", "blank"), ("assistant", "t", None)]
    lattice = C.Lattice(codes(rows), (0, None, None, 0), True)
    cost = lattice.auction(0)
    assert cost == by_sets(rows)[0] == lattice.price[0] - lattice.price[lattice.end]
    for node in range(lattice.end):
        for _, arc, ahead in lattice.arcs(node):
            assert lattice.price[node] <= arc + lattice.price[ahead]


def plain_report(rows):
    """Straight from the contract: ``rows`` are (conv_id, turn, role, text)."""
    show = lambda x: " " if x is None else str(x)
    groups = {}
    for conv, turn, role, text in rows:
        own = groups.setdefault(conv, [])
        role, text = show(role), show(text)
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulty, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = [t for t, *_ in own if t is not None]
        cost, audit = by_sets(faulty)
        fixed = C.repaired(audit, [(r, t) for r, t, _ in faulty])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, key string, alive string"


def report(df):
    out = C.repair_report(C.damaged(df))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = out.collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_report(spark, monkeypatch):
    monkeypatch.setattr(C, "HELD", 300)
    rng = random.Random(7)
    texts = ["Yes.", "No!", "and then", " ", "", "ok? ", "é\U0001f600.", "a\x0b", None, "line\nline.", "Yes."]
    rows = [(c, rng.choice([None, t, t, t, t + 1, t * 2]), rng.choice(["user", "assistant", "assistant", "system", "tool", "", None]), rng.choice(texts))
            for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (None, 2, "assistant", "Hi.")]
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", rng.choice(["word " * 40 + ".", f"row {t}", f"row {t}."])) for t in range(400)]
    rows += [(2000, 5, "user", "Same.")] * 300
    lone = next(c for c in range(3000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(lone, 0, "user", "Gone.")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)
    got, want = report(df), plain_report(rows)
    assert got == want
    assert got[lone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == {}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_supplied_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    assert report(df) == plain_report([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
