"""Conversation repair against plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from tessera.llm import registry, repair

MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
TURN = {0: 2, 1: 2, 2: 3, 3: 2}
NAMES = {2: "user", 3: "assistant"}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_repair(rows):
    """rows: (role, text, fault). The least (cost, audit) of each state, turn by turn."""

    def insertions(states):
        for _ in range(3):
            for q, (cost, audit, out) in list(states.items()):
                new = (cost + 5, audit + "I", [*out, NAMES[TURN[q]] + ":"])
                if TURN[q] not in states or new[:2] < states[TURN[q]][:2]:
                    states[TURN[q]] = new
        return states

    states = insertions({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}
        for q, (cost, audit, out) in states.items():
            options = [(q, 2, "D", [])]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if q in MOVES.get(role[:1], {}):
                    options.append((MOVES[role[:1]][q], extra, "K", [f"{role}:{text}"]))
                options.append((TURN[q], extra + 1, "R", [f"{NAMES[TURN[q]]}:{text}"]))
            for target, price, letter, more in options:
                new = (cost + price, audit + letter, out + more)
                if target not in after or new[:2] < after[target][:2]:
                    after[target] = new
        states = insertions(after)
    cost, audit, out = min((states[q] for q in (0, 3) if q in states), key=lambda s: s[:2])
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_result(rows, harm=True):
    """All columns of one conversation from its (conv_id, turn, role, text)."""
    kept = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if harm else 99
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, judged = set(), []
    for _, role, text in kept:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [t for t, _, _ in kept if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
    return (gaps, *counts, illegal, *plain_repair(judged))


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_words_equal_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), f"t{rng.randrange(9)}", rng.choice([None, None, None, "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(12))]
        turns = repair.Turns()
        for role, text, fault in rows:
            turns.add(role.encode(), text.encode(), role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        assert repair.repaired(turns) == plain_repair(rows), rows


def test_long_conversations_go_block_by_block(monkeypatch, tmp_path):
    monkeypatch.setattr(repair, "BLOCK", 7)
    monkeypatch.setattr(repair, "SPOOL", 100)
    rng = random.Random(9)
    rows = [(rng.choice(["system", "user", "assistant"]), "x" * rng.randrange(30), rng.choice([None, None, "blank", "truncated"])) for _ in range(300)]
    turns = repair.Turns(f"file://{tmp_path}/spool")
    for role, text, fault in rows:
        turns.add(role.encode(), text.encode(), role[:1], fault == "blank", fault == "truncated")
    assert turns.stream is not None and repair.repaired(turns) == plain_repair(rows)
    turns.close()
    assert not list((tmp_path / "spool").iterdir())


def test_every_word_holds_every_state():
    words, todo = {repair.accepting()}, [repair.accepting()]
    while todo:
        w = todo.pop()
        for turn in [(i, f, t) for i in ("s", "u", "a", "") for f in (False, True) for t in (False, True)]:
            new, up = repair.before(w, *turn)
            assert up <= 2 and max(repair.layer(new, q) for q in range(4)) <= 12
            if new not in words:
                words.add(new)
                todo.append(new)
    assert len(words) < 200


def test_query_equals_plain_search_on_the_whole_table(spark):
    base = "/root/testdata/sf0.1"
    rows = by_conversation((r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{base}/conversations.parquet").collect())
    got = {r.conv_id: tuple(r[k] for k in repair._FIELDS) for r in registry.queries()["op11_conversations"](spark, base).collect()}
    assert got == {c: plain_result(v) for c, v in rows.items()}


def test_odd_rows(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "a.", "b", "b. \x0b", "é!", "x" * 200_000 + "?", "\xa0", "a.b"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice([None, "", "system", "user", "assistant", "User", "été"]), rng.choice(texts)) for _ in range(160)]
    rows += [(7, t, "user", "same.") for t in range(60)] + [(8, 2**63 - 1, "user", "a."), (8, -(2**63), "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as c", "'x' as dropped", "2 as copy", "true as seen", "0 as harm")
    for harm in (True, False):
        got = {r.conv_id: tuple(r[k] for k in repair._FIELDS) for r in repair.repair(df, harm=harm).collect()}
        want = {c: plain_result(v, harm) for c, v in by_conversation(rows).items()}
        assert got == {c: (min(v[0], 2**63 - 1), *v[1:]) for c, v in want.items()}


def test_a_conversation_without_rows_after_damage(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (got,) = repair.repair(spark.createDataFrame([(1, turn, "user", "a.")], "conv_id long, turn long, role string, text string")).collect()
    assert tuple(got) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair.repair(empty).collect() == []
