"""Conversation repair against a plain dynamic program and row-by-row bookkeeping."""

import hashlib
import random
import zlib

import pytest

from clickpulse.llm import conversations as cv

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plan(codes, entry=cv.START):
    """Least (cost, audit) per end state by dynamic programming over the rows."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    go = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserts(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                new = go[q][step[q]]
                best[new] = min(best.get(new, (1 << 60, "")), (c + 3, a + "I"))
        return best

    best = inserts({entry: (0, "")})
    for code in codes:
        after = {}
        for q, (c, a) in best.items():
            options = [(q, c + 4, a + "D")]
            if code != "-":
                t = 3 * code.isupper()
                options.append((go[q][step[q]], c + 3 + t, a + "R"))
                if code.lower() in go[q]:
                    options.append((go[q][code.lower()], c + t, a + "K"))
            for q2, c2, a2 in options:
                after[q2] = min(after.get(q2, (1 << 60, "")), (c2, a2))
        best = inserts(after)
    return best


def brute(rows):
    """Expected report row per conversation of damaged rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]

        def digest(r):
            return hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        codes, seen, n = "", set(), dict(blank=0, duplicate=0, truncated=0, illegal=0)
        for _, role, text in mine:
            ink = text.strip("\t\n\x0b\x0c\r ")
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not ink:
                n["blank"] += 1
                code = "-"
            elif (role, text) in seen:
                n["duplicate"] += 1
                code = "-"
            elif ink[-1] not in ".!?":
                n["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
        n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = [r[0] for r in mine if r[0] is not None]
        cost, audit = min(v for q, v in plan(codes).items() if q in (0, 3))
        kept, left = [], iter(mine)
        total = sum(e != "D" for e in audit)
        for e in audit:
            row = next(left) if e != "I" else (None, None, "")
            if e == "D":
                continue
            role = row[1] if e == "K" else ("user" if (len(kept) + total) % 2 == 0 else "assistant")
            kept.append(f"{role}:{row[2]}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"],
                     n["truncated"], n["illegal"], cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def report(spark, rows, conversations=None):
    turns = spark.createDataFrame(rows, SCHEMA)
    asked = turns if conversations is None else spark.createDataFrame(conversations, SCHEMA)
    return {r.conv_id: tuple(r)[1:] for r in cv.repair_report(turns, asked).collect()}


def test_search_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(600):
        codes = "".join(rng.choice("suaxSUAX-") for _ in range(rng.randint(0, 14)))
        got = cv.solve(codes)
        for entry in cv.STATES:
            assert got[entry] == plan(codes, entry), (codes, entry)


def test_joined_stretches_equal_the_whole():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("suaxSUA-") for _ in range(rng.randint(0, 9))) for _ in range(2))
        for entry in cv.STATES:
            assert cv.join(cv.solve(a)[entry], cv.solve(b)) == plan(a + b, entry)


@pytest.mark.parametrize("codes", ["x" * 64, "SUAX" * 16, "s" * 64, "uaUA-" * 12])
def test_long_blocks_are_decided(codes):
    assert cv.solve(codes)[cv.START] == plan(codes)


def random_rows(rng, convs, most, chunk=None):
    rows = []
    for c in range(convs):
        for i in range(rng.randint(0, most)):
            turn = rng.choice([None, i, i, i, i, rng.randint(-5, (chunk or 20))])
            rows.append((c if c else None, turn, rng.choice(["user", "assistant", "system", "tool", None, ""]),
                         rng.choice(["Yes.", "No", "", None, " \t", "Why? ", "Été!", "ok", f"t{i}.", f"t{i}"])))
    return rows


def test_report_equals_brute_force(spark):
    rows = random_rows(random.Random(5), 40, 14)
    got, want = report(spark, rows), brute(rows)
    assert got == want


def test_long_conversation_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(cv, "CHUNK", 4)
    monkeypatch.setattr(cv, "BLOCK", 3)
    rng = random.Random(6)
    rows = [(1, i - 40, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{i}.", ""]))
            for i in range(150)] + [(1, None, "user", "first."), (1, 7, "user", "a."), (1, 7, "user", "a.")]
    assert report(spark, rows) == brute(rows)


def test_conversations_without_rows_and_empty_tables(spark):
    got = report(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")],
                 [(1, 0, "user", "Hi."), (2, 0, "user", "x"), (None, 0, "user", "y")])
    assert got[2] == got[None] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got[1][5:7] == (0, "KK")
    assert report(spark, []) == {}


def test_damage(spark):
    kind = {}
    for t in range(400):
        kind.setdefault(zlib.crc32(f"7:{t}".encode()) % 20, t)
    src = spark.createDataFrame([(7, kind[k], "assistant", "a.b!") for k in range(6)] + [(None, None, None, None)],
                                SCHEMA).selectExpr("*", "1 AS copy", "2 AS kind")
    rows = sorted((tuple(r) for r in cv.damage(src).collect()), key=str)
    none = [(None, None, " ", " ")] * {0: 0, 3: 2}.get(zlib.crc32(b" : ") % 20, 1)
    assert rows == sorted(none + [(7, kind[1], "assistant", ""), (7, kind[2], "assistant", "ab")]
                          + [(7, kind[3], "assistant", "a.b!")] * 2
                          + [(7, kind[4], "user", "a.b!"), (7, kind[5], "assistant", "a.b!")], key=str)


def test_repaired_turns_are_legal(spark):
    rows = random_rows(random.Random(8), 25, 9)
    turns = spark.createDataFrame(rows, SCHEMA)
    by_conv = {}
    for r in sorted(cv.repaired_turns(turns, cv.repair(turns)).collect(), key=lambda r: r.position):
        by_conv.setdefault(r.conv_id, []).append(r.role[:1])
    for roles in by_conv.values():
        text = "".join(roles)
        assert text.removeprefix("s") == "ua" * (len(text) // 2)


def test_very_long_text_and_extra_columns(spark):
    long = "wörd " * 300_000 + "."
    turns = spark.createDataFrame([(1, 0, "user", long, "x"), (1, 1, "assistant", long, "y")],
                                  SCHEMA + ", audit string").selectExpr("*", "'z' AS h", "'q' AS conv")
    got = cv.repair_report(turns, turns).collect()
    assert [(r.cost, r.audit) for r in got] == [(0, "KK")]
    assert got[0].repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
