"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is legal if its role initials read ``(s?(ua)+)?``. Turns can
be kept, given another role or deleted, and empty user or assistant turns
inserted, each at a cost; the repair is the cheapest edit script, among
equally cheap ones the ASCII-least. The search (:func:`solve`) walks an
explicit stack of partial scripts, prunes by lower bounds of the remaining
rows and by the incumbent (cost, audit), and keeps per node (rows read,
state) the best (cost, audit) that reached it, so that a worse prefix goes
no further.

The script of a stretch of turns depends only on the state it starts from
and the one it ends in, so a conversation is cut into chunks of ``CHUNK``
turn numbers that are solved apart, for every state at their start; the
chunks' results are short and are joined in order. A conversation holding a
third of all rows thus spreads over many tasks. Only the digest of the
repaired text (a sequential hash) reads a conversation's rows in one task,
in order and in a stream: no group is ever held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Turn numbers per chunk, and rows the search takes at once.
CHUNK = 256
BLOCK = 64
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

# Row codes: the role's initial (s, u, a, x for any other), in capitals if the
# row is truncated, or - if the row is blank or a duplicate.
_MUST_GO = "-"
# States: nothing written, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_GOES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NEXT = ("u", "u", "a", "u")                    # what a new role or turn must be
_LEGAL_END = (START, ASSISTANT)
_INK = r"[^\x20\x09-\x0D]"


_FAR = 1 << 60


def _edits(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, state after, cost) of one row, in order of the edits' initials."""
    out = [(DELETE, state, DELETE_COST)]
    if code != _MUST_GO:
        truncated = TRUNCATED_COST * code.isupper()
        kept = _GOES[state].get(code.lower())
        if kept is not None:
            out.append((KEEP, kept, truncated))
        out.append((REROLE, _GOES[state][_NEXT[state]], truncated + REROLE_COST))
    return out


def _bounds(codes: str) -> list[list[list[int]]]:
    """[rows read][state][end state]: what the rest costs at least, whatever its audit."""
    def with_inserts(by_state):
        # up to two new turns lead from any state to any that new turns can reach
        for _ in range(2):
            by_state = [[min(c, INSERT_COST + d) for c, d in zip(by_state[q], by_state[_GOES[q][_NEXT[q]]])]
                        for q in STATES]
        return by_state

    rest = [with_inserts([[0 if q == e else _FAR for e in STATES] for q in STATES])]
    for code in reversed(codes):
        after = rest[-1]
        rest.append(with_inserts([[min(cost + after[q2][e] for _, q2, cost in _edits(code, q)) for e in STATES]
                                  for q in STATES]))
    return rest[::-1]


@lru_cache(maxsize=1 << 16)
def solve(codes: str) -> dict[int, dict[int, tuple[int, str]]]:
    """Per start and end state the least (cost, audit) of the rows ``codes``.

    Equal costs are decided by the audits. No audit of a node is a proper
    part of another of the same cost (they edit the same rows, so the longer
    one inserts more and costs more): the better prefix stays the better one
    whatever follows. States that cannot be reached are left out.
    """
    n = len(codes)
    rest = _bounds(codes)
    out = {}
    for entry in STATES:
        incumbent: dict[int, tuple[int, str]] = {}
        seen: dict[tuple[int, int], tuple[int, str]] = {}
        stack = [(0, entry, 0, "")]
        while stack:
            i, state, cost, audit = stack.pop()
            known = seen.get((i, state))
            if known is not None and known <= (cost, audit):
                continue                            # a better prefix has been here
            least = rest[i][state]
            if not any(c < _FAR and (e not in incumbent or cost + c < incumbent[e][0]
                                     or cost + c == incumbent[e][0] and audit <= incumbent[e][1])
                       for e, c in zip(STATES, least)):
                continue                            # no end can beat its incumbent any more
            seen[i, state] = cost, audit
            if i == n and (cost, audit) < incumbent.get(state, (_FAR, "")):
                incumbent[state] = cost, audit
            steps = [(INSERT, i, _GOES[state][_NEXT[state]], cost + INSERT_COST)]
            if i < n:
                steps += [(edit, i + 1, q, cost + c) for edit, q, c in _edits(codes[i], state)]
            # the most promising edit is tried first, among equals the ASCII-least
            steps.sort(key=lambda s: (s[3] + min(rest[s[1]][s[2]]), s[0]), reverse=True)
            stack.extend((j, q, c, audit + edit) for edit, j, q, c in steps)
        out[entry] = incumbent
    return out


def join(first: dict, second: dict) -> dict:
    """Scripts of two stretches in a row: ``first`` by end state, ``second`` by start and end state."""
    out: dict[int, tuple[int, str]] = {}
    for middle, (cost, audit) in first.items():
        for end, (c, a) in second[middle].items():
            both = cost + c, audit + a
            if end not in out or both < out[end]:
                out[end] = both
    return out


def replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit of ``audit``; a deletion has role None."""
    state = START
    odd = sum(e != DELETE for e in audit) % 2
    for at, edit in enumerate(audit):
        role, text = (None, "") if edit == INSERT else next(rows)
        if edit == DELETE:
            yield edit, None, text
            continue
        if odd and state == START:
            state = SYSTEM          # an odd length starts with the system turn, kept
            yield edit, role, text
            continue
        new = _NEXT[state]
        state = _GOES[state][new]
        yield edit, role if edit == KEEP else {"u": "user", "a": "assistant"}[new], text


# ------------------------------------------------------------------ rows

def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``turns`` damaged by crc32(``conv:turn``) modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes it a user's; the other rows stay. Nulls count as one space."""
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(c(conv), F.lit(":"), c(turn))) % 20
    return (turns.select(F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(c(role)).alias(role),
                         F.when(kind == 1, "").when(kind == 2, F.regexp_replace(c(text), "[.!?]", ""))
                         .otherwise(c(text)).alias(text),
                         F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
                                   .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, h): nulls in role and text as one space; ``h`` identifies role and text."""
    r, t = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    return turns.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                        r.alias("role"), t.alias("text"),
                        F.unhex(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256)).alias("h"))


def _order(turn: Column) -> Column:
    """Turn numbers with nulls first."""
    return F.coalesce(turn, F.lit(-(1 << 63)))


def _marked(rows: DataFrame) -> DataFrame:
    """The narrow rows: conv, chunk, turn, role, h, code without duplicates, and ``first``, the turn (nulls
    first) where the same role and text stands first in the conversation."""
    end = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), -1, 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    narrow = rows.select(
        "conv", _order(F.col("turn")).alias("turn"), "role", "h",
        F.when(F.col("turn").isNull(), -(1 << 62)).otherwise(F.expr(f"turn div {CHUNK} - cast(turn % {CHUNK} < 0 as int)"))
        .alias("chunk"),
        F.when(~F.col("text").rlike(_INK), _MUST_GO).when(end.isin(".", "!", "?"), code).otherwise(F.upper(code)).alias("code"))
    # combined map-side, so a text repeated in a hot conversation ships once a task
    met = (narrow.groupBy("conv", "h").agg(F.min("turn").alias("first"), F.count(F.lit(1)).alias("n"))
           .where("n > 1").select(F.col("conv").alias("c2"), F.col("h").alias("h2"), "first"))
    return (narrow.join(met, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("h") == F.col("h2")), "left")
            .drop("c2", "h2"))


_CHUNKS = ("conv long, chunk long, low long, high long, turns long, n_blank long, n_duplicate long, n_truncated long, "
           "illegal long, head string, tail string, scripts array<struct<entry:int,end:int,cost:long,audit:string>>")


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (conversation, chunk) from its rows in order; a chunk is read block by block."""
    schema = pa.schema([(f, pa.int64()) for f in ("conv", "chunk", "low", "high", "turns", "n_blank", "n_duplicate",
                                                  "n_truncated", "illegal")]
                       + [("head", pa.string()), ("tail", pa.string()),
                          ("scripts", pa.list_(pa.struct([("entry", pa.int32()), ("end", pa.int32()),
                                                          ("cost", pa.int64()), ("audit", pa.string())])))])
    out: list[dict] = []
    now = scripts = None
    codes: list[str] = []
    last = None                                   # (turn, role, h) of the row before

    def search():
        nonlocal scripts
        block = "".join(codes)
        codes.clear()
        if scripts is None:
            scripts = solve(block)
        elif block:
            scripts = {e: join(s, solve(block)) for e, s in scripts.items()}

    def close():
        search()
        now["scripts"] = [dict(entry=e, end=x, cost=c, audit=a) for e, s in scripts.items() for x, (c, a) in s.items()]
        out.append(now)

    for batch in batches:
        for row in batch.to_pylist():
            key = row["conv"], row["chunk"]
            if now is None or key != (now["conv"], now["chunk"]):
                if now is not None:
                    close()
                now = dict(conv=key[0], chunk=key[1], low=None, high=None, turns=0, n_blank=0, n_duplicate=0,
                           n_truncated=0, illegal=0, head=None, tail=None)
                scripts, last = None, None
            turn, code, initial = row["turn"], row["code"], row["role"][:1]
            if code == _MUST_GO:
                now["n_blank"] += 1
            elif row["first"] is not None and (turn > row["first"] or last == (turn, row["role"], row["h"])):
                now["n_duplicate"] += 1
                code = _MUST_GO
            elif code.isupper():
                now["n_truncated"] += 1
            if now["head"] is None:
                now["head"] = initial
            else:
                now["illegal"] += now["tail"] + initial not in ("su", "ua", "au")
            if turn != -(1 << 63) and (last is None or last[0] != turn):
                now["turns"] += 1
                now["low"], now["high"] = turn if now["low"] is None else now["low"], turn
            now["tail"], last = initial, (turn, row["role"], row["h"])
            codes.append(code)
            if len(codes) == BLOCK:
                search()
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    if now is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_VERDICTS = ("conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its chunks in order."""
    schema = pa.schema([(f, pa.int64()) for f in ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                       + [("audit", pa.string())])
    out: list[dict] = []
    now = scripts = None

    def close():
        cost, audit = min(scripts[x] for x in _LEGAL_END if x in scripts)
        gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
        out.append(dict(conv=now["conv"], gaps=gaps, blank=now["n_blank"], duplicate=now["n_duplicate"],
                        truncated=now["n_truncated"], illegal=now["illegal"], cost=cost, audit=audit))

    for batch in batches:
        for row in batch.to_pylist():
            table: dict[int, dict] = {}
            for s in row.pop("scripts"):
                table.setdefault(s["entry"], {})[s["end"]] = s["cost"], s["audit"]
            if now is not None and row["conv"] == now["conv"]:
                for f in ("turns", "n_blank", "n_duplicate", "n_truncated", "illegal"):
                    now[f] += row[f]
                now["illegal"] += now["tail"] + row["head"] not in ("su", "ua", "au")
                now["tail"] = row["tail"]
                now["low"] = row["low"] if now["low"] is None else now["low"]
                now["high"] = now["high"] if row["high"] is None else row["high"]
                scripts = join(scripts, table)
                continue
            if now is not None:
                close()
            now, scripts = row, table[START]
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    if now is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[dict]]]:
    """(verdict row, the rows of the conversation that follow it), in a stream."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        verdict, row = row, None

        def turns():
            nonlocal row
            for r in rows:
                if r["audit"] is not None:
                    row = r
                    return
                yield r
        following = turns()
        yield verdict, following
        for _ in following:
            pass


_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _meet(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every conversation's verdict followed by its rows in order, whole conversations in one partition."""
    none = lambda t: F.lit(None).cast(t)
    first = verdicts.select("conv", none("bigint").alias("turn"), none("string").alias("role"), none("string").alias("text"),
                            none("binary").alias("h"), "audit", *_FACTS)
    after = rows.select("conv", _order(F.col("turn")).alias("turn"), "role", "text", "h", none("string").alias("audit"),
                        *[none("bigint").alias(c) for c in _FACTS])
    return (first.unionByName(after).repartition("conv")
            .sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "h"))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row per conversation.

    Rows are taken in order of the turn number, nulls first; rows of one
    number in order of role and of the digest of role and text. Defined edge
    cases: a null or empty conversation id is a conversation of its own; a
    null role or text counts as one space; equal rows of one number are
    duplicates of the first; a very long text is only digested; a very long
    conversation is solved in chunks; an empty table gives an empty result;
    other columns are not read.
    """
    chunks = (_marked(_rows(turns, conv, turn, role, text)).repartition("conv", "chunk")
              .sortWithinPartitions("conv", "chunk", "turn", "role", "h")
              .select("conv", "chunk", "turn", "role", "h", "code", "first").mapInArrow(_summarise, _CHUNKS))
    out = chunks.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_combine, _VERDICTS)
    return out.withColumnRenamed("conv", conv)


def repaired_turns(turns: DataFrame, verdicts: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position, edit, role, text): the turns after the edits of ``repair``, deletions left out."""
    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for verdict, rows in _by_conversation(batches):
            part = []
            place = 0
            for edit, r, t in replay(verdict["audit"], ((x["role"], x["text"]) for x in rows)):
                if edit != DELETE:
                    part.append((verdict["conv"], place, edit, r, t))
                    place += 1
                if len(part) == 1000:
                    yield _turn_batch(part)
                    part = []
            if part:
                yield _turn_batch(part)

    out = _meet(_rows(turns, conv, turn, role, text), verdicts.withColumnRenamed(conv, "conv"))
    return (out.mapInArrow(edited, "conv long, position long, edit string, role string, text string")
            .withColumnRenamed("conv", conv))


def _turn_batch(part: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], t) for k, t in enumerate(kinds)],
                                      ["conv", "position", "edit", "role", "text"])


def repaired_digest(turns: DataFrame, verdicts: DataFrame, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """``verdicts`` (of ``repair``) plus ``repaired_sha256``, the hash of each repaired conversation's
    ``role:text``, joined by line feeds."""
    schema = pa.schema([("conv", pa.int64())] + [(c, pa.int64()) for c in _FACTS]
                       + [("audit", pa.string()), ("digest", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for verdict, rows in _by_conversation(batches):
            hashed, gap = hashlib.sha256(), b""
            for edit, r, t in replay(verdict["audit"], ((x["role"], x["text"]) for x in rows)):
                if edit != DELETE:
                    hashed.update(gap + f"{r}:{t}".encode("utf-8", "surrogatepass"))
                    gap = b"\n"
            out.append({**{c: verdict[c] for c in ("conv", *_FACTS, "audit")}, "digest": hashed.hexdigest()})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    out = _meet(_rows(turns, conv, turn, role, text), verdicts.withColumnRenamed(conv, "conv"))
    return (out.mapInArrow(digest, _VERDICTS + ", digest string")
            .withColumnsRenamed({"conv": conv, "digest": "repaired_sha256"}))


def repair_report(turns: DataFrame, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One row per id of ``conversations``: the counts, cost and audit of ``repair`` and ``repaired_sha256``.

    Ids without rows in ``turns`` get zeros, an empty audit and the hash of
    the empty text. ``turns`` must give the same rows whenever it is read.
    """
    verdicts = repair(turns, conv, turn, role, text)
    none = [F.lit(0).cast("bigint").alias(c) for c in _FACTS] + [F.lit("").alias("audit"), F.lit(1).alias("lacks")]
    ids = conversations.select(F.col(conv).cast("bigint").alias(conv)).distinct().select(conv, *none)
    known = verdicts.select("*", F.lit(0).alias("lacks")).unionByName(ids)
    facts = (known.groupBy(conv).agg(F.min_by(F.struct(*_FACTS, "audit"), "lacks").alias("v")).select(conv, "v.*"))
    return repaired_digest(turns, facts, conv, turn, role, text)


__all__ = ["damage", "repair", "repair_report", "repaired_digest", "repaired_turns", "replay", "solve"]
