"""Conversation repair against brute force over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tierflow.llm import conversation_repair as cr

GOOD = re.compile("(s?(ua)+)?")
DDL = "conv_id long, turn long, role string, text string, cost int, copies string"


def brute_edits(rows):
    """Least (cost, audit, messages) over all edits of (role, text, fault) rows, two inserts a gap at most."""
    ways = [(0, "", ())]
    for role, text, fault in rows:
        more = cr.TRUNCATED if fault == "truncated" else 0
        nxt = []
        for cost, audit, out in ways:
            nxt.append((cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                for k in range(3):
                    for names in itertools.product(("user", "assistant"), repeat=k):
                        start, c = out + tuple((x, "") for x in names), cost + 5 * k + more
                        nxt.append((c, audit + "I" * k + "K", (*start, (role, text))))
                        nxt += [(c + 1, audit + "I" * k + "R", (*start, (x, text))) for x in ("user", "assistant")]
        ways = list(set(nxt))
    ends = [(c + 5 * k, a + "I" * k, o + tuple((x, "") for x in names)) for c, a, o in ways for k in range(3) for names in itertools.product(("user", "assistant"), repeat=k)]
    return min(w for w in ends if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in w[2])))


def marked(rows):
    """(role, text, fault) of (turn, role, text) rows in order, and the counts."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, out = set(), []
    for _, role, text in rows:
        tail = re.sub("[\x20\x09-\x0d]+\\Z", "", text)[-1:]
        fault = "blank" if not tail else "duplicate" if (role, text) in seen else "" if tail in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    first = [r[:1] for r, _, _ in out]
    counts = [max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == k for _, _, f in out) for k in ("blank", "duplicate", "truncated"))]
    return out, (*counts, sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)))


def brute(rows):
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        found, counts = marked([r[1:4] for r in rows if r[0] == conv])
        cost, audit, messages = brute_edits(found)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()
        out.append((conv, *counts, cost, audit, sha, [tuple(m) for m in messages]))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)
    got = cr.repair(df, messages=True, **kw).collect()
    return sorted([(*r[:-1], [tuple(m) for m in r.messages]) for r in got], key=str)


def conversations(seed, n=120, most=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for _ in range(rng.randint(1, most)):
            turn = rng.choice([None, *range(4)])
            rows.append((c if c else None, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "usher", "User"]), rng.choice(["Hi.", "Ho", "what?", "", " \t\n\x0b\x0c\r", None, "é!", "end. \n", "x ", "Ho"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_all_edits(spark, seed):
    rows = conversations(seed)
    assert run(spark, rows) == brute(rows)


def test_table_accepts_the_role_grammar():
    p = cr.Parser()
    for k in range(8):
        for roles in itertools.product("sua", repeat=k):
            tops = {p.root}
            for role in roles:
                tops = {after for node in tops for after in p.shift(node, role)}
            assert any(map(p.accepts, tops)) == bool(GOOD.fullmatch("".join(roles)))


def test_equal_stacks_are_one_node():
    p = cr.Parser()
    tops = {p.root: (0, "")}
    for symbol in "suauaSxua-uA" * 30:
        tops = p.step(tops, symbol)
        assert len(tops) < 12


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_compose(monkeypatch, block):
    rng = random.Random(block)
    for _ in range(60):
        rows = [(i // 2, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", "c!", "d?", "e."]) + str(rng.randrange(4)) * rng.randrange(2)) for i in range(rng.randint(0, 24))]
        found = []
        for size in (10_000, block):
            monkeypatch.setattr(cr, "BLOCK", size)
            c = cr.Conversation(True)
            for turn, role, text in rows:
                tail = text.rstrip(cr.WHITE)[-1:]
                c.add(turn, role, text, "blank" if not tail else "" if tail in cr.ENDS else "truncated")
            found.append(c.close())
        assert found[0] == found[1]


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(150), None) for t in (*range(5), None) for r, x in [("user", "One. Two! Three?"), (None, None)][: 1 + (c is None)]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)
    want = []
    for c, t, r, x in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        want.append((c, t, "user" if code == 4 else r, "" if code < 2 else re.sub("[.!?]", "", x) if code == 2 else x, {0: 0, 3: 2}.get(code, 1)))
    assert sorted(map(repr, (tuple(r) for r in cr.damaged(df).collect()))) == sorted(map(repr, want))


def test_long_and_dropped_conversations(spark):
    long = [(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(2000) if t != 777]
    df = spark.createDataFrame([(*r, 1, "1") for r in long] + [(2, 5, "user", "gone.", 1, "0"), (3, 1, "user", "a" * 300_000 + ".", 1, "2")], DDL)
    got = {r.conv_id: r for r in cr.repair(df, copies_col="copies").collect()}
    # the assistant's row of turn 777 is missing: one of its neighbours goes
    assert (got[1].gaps, got[1].illegal, got[1].cost, got[1].audit.count("D")) == (1, 1, 2 + 0, 1)
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert tuple(got[3])[1:8] == (0, 0, 1, 0, 1, 4, "DD")


def test_empty_table(spark):
    assert cr.repair(spark.createDataFrame([], DDL), messages=True).collect() == []
