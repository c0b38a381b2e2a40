"""Prefix trie and structure repair against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from stockloom.llm import prefix_trie, repair, scan
from stockloom.llm.queries import QUERIES
from conftest import SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string"


def _key(row):
    return (row[1] is not None, row[1] or 0)


# --- repair -----------------------------------------------------------------------


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def _repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's rows in order."""
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        left = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}  # state: the last role's initial
    name = {"u": "user", "a": "assistant"}
    best = {s: (0, "", []) for s in ("", "a")}  # state to (cost, edits, lines)

    def insert(best):
        for _ in range(4):
            for s in nxt:
                if nxt[s] in best:
                    cost, edits, lines = best[nxt[s]]
                    found = (cost + 3, "I" + edits, [name[nxt[s]] + ":", *lines])
                    if s not in best or found[:2] < best[s][:2]:
                        best[s] = found

    insert(best)
    for (_, _, role, text), fault in zip(reversed(rows), reversed(faults)):
        new = {}
        for s in nxt:
            ways = []
            if s in best:
                cost, edits, lines = best[s]
                ways.append((cost + 4, "D" + edits, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == nxt[s] or (role[:1] == "s" and s == ""):
                    if role[:1] in best:
                        cost, edits, lines = best[role[:1]]
                        ways.append((cost + more, "K" + edits, [f"{role}:{text}", *lines]))
                if nxt[s] in best:
                    cost, edits, lines = best[nxt[s]]
                    ways.append((cost + more + 3, "R" + edits, [f"{name[nxt[s]]}:{text}", *lines]))
            if ways:
                new[s] = min(ways, key=lambda w: w[:2])
        best = new
        insert(best)
    cost, edits, lines = best[""]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _plain_repair(rows, damage=True):
    out, kept = {}, _damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (*_key(r), r[2], r[3]))
        out[conv] = _repaired(own)
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _rows(df):
    return {r[0]: tuple(r[1:]) for r in df.select(*NAMES).collect()}


def test_repair_of_the_given_table_equals_plain_version(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    got = QUERIES["op13_conversation_repair"](spark, SF_DIR)
    assert sorted(got.columns) == sorted(NAMES)
    assert _rows(got) == _plain_repair([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def _random_rows(drawn, convs, most):
    rows = []
    for conv in range(convs):
        for turn in range(drawn.randrange(1, most)):
            role = drawn.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = drawn.choice(["Yes.", "No", "Why?", "", " \n", None, f"Text {drawn.randrange(99)}.", f"open {drawn.randrange(99)}", "ä" * 300 + "."])
            rows.append((conv if conv else None, None if drawn.random() < 0.05 else turn + (turn > 5), role, text))
    return rows


@pytest.mark.parametrize("chunk", [64, 3])
def test_repair_of_odd_rows_equals_plain_version(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(scan, "FAN", 2)
    drawn = random.Random(chunk)
    rows = _random_rows(drawn, 60, 12)
    rows += [(500, t, drawn.choice(["user", "assistant"]), f"Line {t}.") for t in range(90)]
    rows += [(501, 7, "user", "Same.")] * 20 + [(502, None, None, None)] * 3
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", at long, fault string")
    assert _rows(repair.repaired(repair.damaged(table), table)) == _plain_repair(rows)
    assert _rows(repair.repaired(table)) == _plain_repair(rows, damage=False)


def test_repair_of_an_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(repair.damaged(table), table).collect() == []
    gone = [c for c in range(4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    table = spark.createDataFrame([(c, 0, "user", "Hi.") for c in gone], SCHEMA)
    empty = hashlib.sha256().hexdigest()
    assert _rows(repair.repaired(repair.damaged(table), table)) == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in gone}


def test_auction_prices_are_dual_optimal():
    """Costs equal those of plain relaxation, prices undercut no arc, and pieces put together equal the whole."""
    drawn = random.Random(5)
    for _ in range(200):
        codes = "".join(drawn.choice("ssuuuaaaaxxSUAX0123") for _ in range(drawn.randrange(1, 14)))
        arcs, price = repair.arcs_of(codes, repair.END), repair.floor_prices(codes, repair.END)
        costs = [repair.auction(arcs, price, s) for s in range(repair.STATES)]
        best = [repair.FAR] * (len(arcs) - 1) + [0]
        for _ in arcs:
            best = [min([c + best[to] for _, c, to in a], default=b) for a, b in zip(arcs, best[:-1])] + [0]
        assert costs == best[: repair.STATES]
        assert all(price[node] <= cost + price[to] for node, a in enumerate(arcs) for _, cost, to in a)
        cut = drawn.randrange(0, len(codes))
        whole = repair.times(repair.crossing(codes[:cut]), repair.crossing(codes[cut:]))
        ends = [min(whole[s * 4 + q] + repair.END[q] for q in range(4)) for s in range(4)]
        assert ends == costs


# --- trie -------------------------------------------------------------------------


def _plain_trie(rows):
    convs = {}
    for r in rows:
        if r[0] is not None:
            convs.setdefault(r[0], []).append((*_key(r), r[2] or "", r[3] or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        new[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, ts in new.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children = {n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n] for n in members}
    saved = {n: (len(m) - 1) * len(n[-1][1].encode()) if n else 0 for n, m in members.items()}

    def below(n):
        return [n, *(x for c in children[n] for x in below(c))]

    out = []
    for n, m in members.items():
        tree = below(n)
        ends = ",".join(map(str, sorted(c for c in m if new[c] == n)))
        out.append(
            (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]),
             sum(not children[x] for x in tree), sum(saved[x] for x in tree), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize(("cell", "piece", "height"), [(64, 1024, 8), (3, 2, 2)])
def test_trie_of_odd_rows_equals_plain_version(spark, monkeypatch, cell, piece, height):
    monkeypatch.setattr(prefix_trie, "CELL", cell)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    drawn = random.Random(cell)
    rows = _random_rows(drawn, 80, 14) + [(-7, 0, "user", "Hi"), (-5, 0, "user", "Hi"), (-5, 1, None, None)]
    rows += [(c, t, "user", f"Text {t}") for c in range(1000, 1030) for t in range(3)]
    rows += [(900, t, "user", f"Text {t}") for t in range(40)] + [(901, t, "user", f"Text {t}") for t in range(38)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", depth long, p1 long")
    convs, turned = prefix_trie.rebuilt(prefix_trie.turns(table))
    got = prefix_trie.nodes_of(prefix_trie.paths(convs, turned), height).select(*NODE).collect()
    assert sorted(map(tuple, got), key=str) == _plain_trie(rows)


def test_trie_of_an_empty_table(spark):
    table = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert prefix_trie.trie(table).collect() == [] == prefix_trie.trie(table.limit(0)).collect()
