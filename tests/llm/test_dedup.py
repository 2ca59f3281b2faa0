"""Exact dedup (op9), SimHash (op3) and line dedup (op8) against brute force."""

import hashlib
import random
import re
import time
from pathlib import Path

import duckdb
import pytest
import xxhash

from clickpulse.llm import exact_dedup as ed
from clickpulse.llm import line_dedup as ld
from clickpulse.llm import queries
from clickpulse.llm.common import materialize
from clickpulse.llm.components import connected_components
from clickpulse.llm.exact_dedup import exact_dedup
from clickpulse.llm.line_dedup import line_dedup
from clickpulse.llm.simhash import fingerprint, simhash_dedup, simhash_groups
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, prose, vocabulary

WHITE = re.compile(r"[\x20\x09-\x0D]+")


# ------------------------------------------------------------- exact dedup

def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(WHITE.sub(" ", t or ""), []).append(i)
    return groups


def test_exact_dedup_against_brute_force(spark):
    rng = random.Random(1)
    words = vocabulary(rng, 60)
    texts = [prose(rng, words, rng.randint(0, 6)) for _ in range(120)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\t\n"]))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "x" * 300_000)]
    got = {r.doc_id: r for r in exact_dedup(documents(spark, rows)).collect()}
    groups = exact_brute(rows)
    assert len(got) == len(rows)
    for norm, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (min(ids), len(ids), i == min(ids))
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_exact_dedup_saturated_filter_gives_the_same(spark):
    rows = [(i, f"t{i % 70}") for i in range(200)]
    docs = documents(spark, rows)
    cols = ["doc_id", "keep_id", "group_size", "kept"]
    assert (sorted(exact_dedup(docs, max_filter_bits=64).select(cols).collect())
            == sorted(exact_dedup(docs).select(cols).collect()))


def test_exact_dedup_only_shuffles_possible_repeats(spark):
    docs = documents(spark, [(i, f"only {i}") for i in range(300)] + [(900, "only 5")])
    hashes = ed.repeated_hashes(docs.withColumn("k", ed.text_key(docs.text)), "k")
    assert hashes.count() == 1
    hit = ed.bloom_filter(hashes, ed.filter_bits(1))
    assert 1 <= sum(int(x).bit_count() for x in hit) <= 2      # unique rows set no slot, however many


def test_exact_dedup_filter_follows_the_repeats():
    assert ed.filter_bits(0) == 1 << 16
    assert ed.filter_bits(1 << 20) == ed.BITS_PER_ENTRY << 20
    assert ed.filter_bits(1 << 40) == ed.MAX_FILTER_BITS


def test_exact_dedup_edges(spark):
    assert exact_dedup(documents(spark, [])).count() == 0
    docs = documents(spark, [(3, "a"), (3, "a"), (None, "a"), (7, "a"), (None, "b"), (None, "b")])
    docs = docs.selectExpr("*", "'mine' AS keep_id", "1 AS group_size", "'g' AS d", "'h' AS g")
    got = exact_dedup(docs).collect()
    assert len(got) == 6
    a = [r for r in got if r.text == "a"]
    assert [r.keep_id for r in a] == [3] * 4 and sum(r.kept for r in a) == 1
    assert [r.doc_id for r in a if r.kept] == [3]
    b = [r for r in got if r.text == "b"]
    assert {r.keep_id for r in b} == {None} and sum(r.kept for r in b) == 1
    assert {r.d for r in got} == {"g"}


# ----------------------------------------------------------------- SimHash

def simhash_brute(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(values):
    """values: id -> fingerprint; smallest id reachable over links of at most 3 bits."""
    root = {i: i for i in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(values)
    for x in ids:
        for y in ids:
            if x < y and (values[x] ^ values[y]).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprint_matches_definition():
    rng = random.Random(2)
    words = vocabulary(rng, 200) + ["ÉÀ", "ÄSS", "Word"]
    for n in (0, 1, 2, 3, 4, 50, 700):
        t = prose(rng, words, n)
        assert fingerprint(t.encode()) == simhash_brute(t)


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    from clickpulse.llm import simhash
    rng = random.Random(3)
    t = prose(rng, vocabulary(rng, 300), 3000)
    whole = fingerprint(t.encode())
    for block in (1, 64, 1000):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert fingerprint(t.encode()) == whole


def test_simhash_groups_against_brute_force(spark):
    rng = random.Random(4)
    words = vocabulary(rng, 400)
    rows = []
    for g in range(12):
        base = prose(rng, words, 120).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 7 % 211 + 1000 * len(rows), " ".join(copy)))
    rows += [(5, None), (6, " "), (7, "one"), (8, "one"), (9, "one two")]
    want = components_brute({i: simhash_brute(t) for i, t in rows})
    assert len(set(want.values())) < len(rows)
    got = simhash_groups(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{simhash_brute(t):016x}" for i, t in rows}


def test_simhash_links_bit_patterns(spark):
    """Chains of fingerprints whose differing bits fall in every split of the two segments."""
    from clickpulse.llm.simhash import _leader_links, _variant_links
    from pyspark.sql import functions as F
    rng = random.Random(5)
    values = set()
    for _ in range(60):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(4):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 4)):
                w ^= 1 << b
            values.add(w)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v, v) for v in signed], "fp bigint, g bigint")
    links = _leader_links(fps.select("fp"), 3).unionByName(_variant_links(fps, 3)).collect()
    got = {frozenset((r.a, r.b)) for r in links}
    want = {frozenset((a, b)) for a in signed for b in signed
            if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert got == want


def test_simhash_dedup_edges(spark):
    assert simhash_dedup(documents(spark, [])).count() == 0
    docs = documents(spark, [(4, "same words here now"), (4, "same words here now"), (2, "same  words here now"),
                             (None, None), (9, ""), (11, "quite another text for sure")])
    docs = docs.selectExpr("*", "1 AS fp", "2 AS component", "3 AS k")
    got = simhash_dedup(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 9, 11]


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(500, 500)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"),
                                                        "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


# -------------------------------------------------------------- line dedup

def lines_brute(rows):
    """rows: (id, text); line numbers removed per id."""
    seen, gone = [], {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            w = set(re.findall(r"[^\x20\x09-\x0D]+", line))
            if not w:
                continue
            if any(9 * len(w & s) >= 4 * (len(w) + len(s)) for s in seen):
                gone.setdefault(i, []).append(k)
            seen.append(w)
    return gone


def line_rows(seed):
    rng = random.Random(seed)
    words = vocabulary(rng, 90)
    base = [prose(rng, words, rng.randint(1, 25)) for _ in range(60)]
    rows = []
    for i in range(70):
        lines = []
        for _ in range(rng.randint(0, 6)):
            ws = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                ws[rng.randrange(len(ws))] = rng.choice(words)
            lines.append("  ".join(ws) if rng.random() < .1 else " ".join(ws))
        rows.append((i * 3 % 71, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [6, 7])
def test_line_dedup_against_brute_force(spark, seed):
    rows = line_rows(seed)
    want = lines_brute(rows)
    got = {r.doc_id: r for r in line_dedup(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        gone = want.get(i, [])
        assert list(got[i].removed_lines) == gone
        assert got[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    assert sum(map(len, want.values())) > 50


def test_line_dedup_group_of_near_copies(spark):
    """A large group of near copies of one line."""
    rng = random.Random(8)
    words = vocabulary(rng, 500)
    base = prose(rng, words, 40).split()
    rows = []
    for i in range(150):
        ws = list(base)
        for _ in range(rng.randint(0, 5)):
            ws[rng.randrange(40)] = rng.choice(words)
        rows.append((i, " ".join(ws) + "\n" + prose(rng, words, 12)))
    want = lines_brute(rows)
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup(documents(spark, rows)).collect()}
    assert {i: v for i, v in got.items() if v} == want


def test_line_dedup_long_lines_against_brute_force(spark):
    """Lines around the length from which sets have 128 parity bits, edited around the threshold."""
    rng = random.Random(9)
    words = vocabulary(rng, 3000)
    rows = []
    for g in range(60):
        base = prose(rng, words, rng.randint(50, 130)).split()
        for c in range(3):
            ws = list(base)
            for _ in range(round(len(ws) * rng.choice([0.05, 0.08, 0.1, 0.11, 0.12, 0.15]))):
                k = rng.randrange(len(ws))
                ws[k:k + 1] = rng.choice([[], [rng.choice(words)], [ws[k], rng.choice(words)]])
            rows.append((g + 60 * c, rng.choice([" ", " ", "\t", "\r\x0b"]).join(ws)))
    want = lines_brute(rows)
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup(documents(spark, rows)).collect()}
    assert {i: v for i, v in got.items() if v} == want
    assert 20 < len(want) < 110


def test_line_dedup_keeps_no_shuffle_files(spark):
    """What a step has shuffled goes with the step, and the session's setting stays as it was."""
    local = Path(spark.sparkContext.getConf().get("spark.local.dir"))
    shuffled = lambda: {f.name for f in local.rglob("shuffle_*.data")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_to = shuffled(), spark.conf.get(key, None)
    line_dedup(documents(spark, line_rows(6)))
    for _ in range(100):            # executors remove files in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(key, None) == set_to


def test_line_dedup_plans_stay_small(spark, monkeypatch):
    """No step repeats the plans of the steps before it, which filled the driver's memory."""
    sizes = []

    def spy(df, *args, **named):
        sizes.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return materialize(df, *args, **named)

    monkeypatch.setattr(ld, "materialize", spy)
    line_dedup(documents(spark, line_rows(7)))
    assert sizes and max(sizes) <= 20


def test_line_dedup_cuts_words_once(spark, monkeypatch):
    """Counts and keys read the kept hashes of the words; one side of the pair join is the shorter prefix."""
    plans = {}

    def spy(df, label, *args, **named):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, label, *args, **named)

    monkeypatch.setattr(ld, "materialize", spy)
    line_dedup(documents(spark, line_rows(7)))
    assert "InMemoryRelation" in plans["keyed-sets"]
    assert "MONOTONICALLY_INCREASING_ID" in plans["line-pairs"].upper()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_line_dedup_lines_of_different_length_against_brute_force(spark):
    """Lines that add words to another line or drop some, around the threshold, in either order."""
    rng = random.Random(10)
    words = vocabulary(rng, 2000)
    rows = []
    for g in range(80):
        base = prose(rng, words[:300], rng.randint(8, 90)).split()
        longer = list(base)
        for _ in range(round(len(set(base)) * rng.choice([0.1, 0.2, 0.24, 0.25, 0.26, 0.3]))):
            longer.insert(rng.randrange(len(longer)), rng.choice(words[300:]))
        pair = [" ".join(base), " ".join(longer)]
        rng.shuffle(pair)
        rows += [(g, pair[0]), (g + 80, pair[1])]
    want = lines_brute(rows)
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup(documents(spark, rows)).collect()}
    assert {i: v for i, v in got.items() if v} == want
    assert 20 < len(want) < 80


def test_line_dedup_edges(spark):
    assert line_dedup(documents(spark, [])).count() == 0
    docs = documents(spark, [(1, "a b\n\n  \na b"), (1, "a b\n\n  \na b"), (2, None), (3, ""), (None, "a b\nnew line"),
                             (4, "a b")])
    docs = docs.selectExpr("*", "'x' AS hash", "'y' AS line", "'z' AS removed", "7 AS n_lines")
    got = line_dedup(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.n_lines) for r in got] == [
        (None, "new line", 2), (1, "a b\n\n  ", 4), (1, "a b\n\n  ", 4), (2, None, 0), (3, "", 1), (4, "", 1)]
    assert {r.hash for r in got} == {"x"}


def test_line_dedup_plan_is_native(spark):
    plan = line_dedup(documents(spark, [(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|BroadcastNestedLoop", plan)


# ------------------------------------------------------------------ oracles

@pytest.mark.parametrize("name", ["op1_mix", "op8_line_dedup", "op9_exact_dedup", "op10_warc"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    rows = sorted(map(str, (tuple(r) for r in got.select(cols).collect())))
    con.execute(queries.oracle_sql()[name])
    names = [x[0] for x in con.description]
    want = [dict(zip(names, r)) for r in con.fetchall()]
    assert rows == sorted(str(tuple(r[c] for c in cols)) for r in want)
