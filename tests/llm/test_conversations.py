import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from pricetrend.llm import conversations as C
from pricetrend.llm.conversations import RepairParams


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        row = (turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
        out += [row] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))


def plain_repair(rows):
    """Cheapest edits by trying everything: least (cost, initials), with the rows they give."""
    kinds, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, so_far, inserted):
        """so_far: what the initials given so far amount to ('', 's', 'u' or 'a' at the end)."""
        ways = []
        if i == len(rows):
            if so_far in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, r = best(i + 1, so_far, 0)
            ways.append((2 + c, "D" + a, r))
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 * (kinds[i] == "truncated")
                for name, cost, letter in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if so_far + role_initial(name) in ("s", "u", "su", "ua", "au"):
                        c, a, r = best(i + 1, role_initial(name), 0)
                        ways.append((cost + more + c, letter + a, (f"{name}:{text}", *r)))
        if inserted < 4:
            for name in ("user", "assistant"):
                if so_far + name[0] in ("u", "su", "ua", "au"):
                    c, a, r = best(i, name[0], inserted + 1)
                    ways.append((5 + c, "I" + a, (name + ":", *r)))
        return min(ways, key=lambda w: w[:2]) if ways else (10 ** 9, "", ())

    cost, audit, lines = best(0, "", 0)
    known = [t for t, _, _ in rows if t is not None]
    initials = [role_initial(r) for _, r, _ in rows]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def role_initial(role):
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


def talks(n, seed=3, longest=9):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None])
            text = rng.choice(["Yes.", "no", "Why? \t", " \n ", "", None, "Same text!", f"Text {rng.random()}.", "dots... and", "é ß 漢!", "x."])
            out.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return out + out[::9]


SCHEMA = "conv_id long, turn long, role string, text string"


def by_conv(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def compare(got, rows):
    got = {r["conv"]: tuple(r)[1:] for r in got}
    want = {c: plain_repair(plain_damage(v)) for c, v in by_conv(rows).items()}
    assert set(got) == set(want)
    for c in want:
        assert got[c] == want[c], (c, plain_damage(by_conv(rows)[c]))


@pytest.mark.parametrize("block", [1, 3, 4])
def test_short_conversations(spark, block):
    rows = talks(400, seed=block) + [(None, 1, "user", "Hi."), (None, None, None, None), (9001, None, "user", "A."), (9001, None, "assistant", "B.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS kind").repartition(5)
    compare(C.repaired(C.damaged(df), RepairParams(block=block)).collect(), rows)


def test_long_conversations_are_split(spark):
    rows = talks(25, seed=11) + [(500 + i % 2, t, r, x) for i, (_, t, r, x) in enumerate(talks(30, seed=12))]
    rows += [(700, 1, "user", "Same.")] * 40 + [(700, t, "user" if t % 3 else "assistant", "Same.") for t in range(60)] + [(701, None, "user", "Hm")] * 30
    rows += [(None, t, "user" if t % 2 else "assistant", "ok. " * (t % 5)) for t in range(40)]
    gone = next(i for i in range(1000, 3000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows += [(gone, 1, "user", f"All dropped {i}.") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    compare(C.repaired(C.damaged(df), RepairParams(long_rows=8, per_piece=10)).collect(), rows)
    # long by its bytes
    compare(C.repaired(C.damaged(df), RepairParams(long_bytes=40, per_piece=7)).collect(), rows)


def test_all_dropped_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    got = C.repaired(C.damaged(spark.createDataFrame([(gone, 1, "user", "Hi.")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.repaired(C.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_very_long_text_and_undamaged(spark):
    text = "word " * 400_000 + "."
    rows = [(1, 0, "system", "S."), (1, 1, "user", text), (1, 2, "assistant", text)]
    got = C.repaired(C.undamaged(spark.createDataFrame(rows, SCHEMA))).first()
    assert (got["audit"], got["cost"]) == ("KKK", 0)
    assert got["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows).encode()).hexdigest()


def test_block_tables_are_the_single_steps():
    t = C.Tables(3)
    for code in (0, 7, 189, 573, 999):
        for v in range(len(t.vectors)):
            at, low = v, 0
            for s in (code % 10, code // 10 % 10, code // 100):
                at, low = t.to[s, at], low + t.low[s, at]
            assert (t.block_to[code, v], t.block_low[code, v]) == (at, low)
