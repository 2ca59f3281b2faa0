"""Ranked search against scoring document by document; the additive quality model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpulse.llm import quality as ql
from clickpulse.llm import ranked_search as rs
from clickpulse.llm.queries import crc_fold
from tests.llm.helpers import documents, prose, vocabulary

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    bags = [(d, Counter(cut(t)), len(cut(t))) for d, t in docs]
    n_docs, length = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for d, bag, n in bags:
            m = 75 + 25 * n * n_docs // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in cut(text) if bag[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def ranking(spark, docs, items, top=20, parts=3):
    d = documents(spark, docs).repartition(parts)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in rs.ranked_search(d, i, top).collect()), key=str)


def corpus(rng):
    words = vocabulary(rng, 60) + ["Été", "naïve", "ÄÖ", "x1", "42", "日本"]
    docs = [(k, prose(rng, words, rng.randint(0, 30)).replace(" ", rng.choice([" ", "\n", "-", "_", "  "])))
            for k in range(150)]
    same = prose(rng, words, 12)
    docs += [(1000 + k, same) for k in range(60)]                       # one class beyond the top
    docs += [(2000 + k, same.upper() + "!" * k) for k in range(5)]      # the same bag in another dress
    docs += [(3000, None), (3001, ""), (3002, " .,"), (None, same), (7, same), (7, same)]
    rng.shuffle(docs)
    items = [(k, prose(rng, words, rng.randint(1, 8))) for k in range(12)]
    return docs, items + [(50, None), (51, "..."), (52, "nowhere"), (53, same), (0, same[:20])]


def test_ranking_equals_brute_force(spark):
    docs, items = corpus(random.Random(1))
    assert ranking(spark, docs, items) == brute(docs, items)
    assert ranking(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_items_in_blocks(spark, monkeypatch):
    docs, items = corpus(random.Random(2))
    monkeypatch.setattr(rs, "ITEM_BLOCK", 5)
    monkeypatch.setattr(rs, "STEP_CELLS", 16)
    monkeypatch.setattr(rs, "TEXT_BLOCK", 11)
    assert ranking(spark, docs, items) == brute(docs, items)
    monkeypatch.setattr(rs, "BLOCK_TERMS", 4)
    assert ranking(spark, docs[:40], items) == brute(docs[:40], items)


def test_search_edges(spark):
    assert ranking(spark, [], [(1, "a")]) == []
    assert ranking(spark, [(1, "a")], []) == []
    assert ranking(spark, [(1, None), (2, "?")], [(1, "a")]) == []
    long = [(1, "alpha beta " * 200_000), (2, "alpha"), (3, "ALPHA gamma")]
    assert ranking(spark, long, [(9, "Alpha beta alpha")]) == brute(long, [(9, "Alpha beta alpha")])
    wide = documents(spark, [(1, "a b"), (2, "a")]).selectExpr("*", "1 AS vec", "2 AS n", "3 AS id", "4 AS rank", "5 AS h")
    items = spark.createDataFrame([(1, "a b", 7)], "item_id smallint, text string, item int")
    got = rs.ranked_search(wide, items).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [(1, 1, 1), (1, 2, 2)]


def test_terms_in_blocks():
    text = ("Ab1 c-d_é" * 50 + "日本語" * 3000).encode()
    whole = [t for b in rs.terms(text) for t in b]
    rs_block, rs.TEXT_BLOCK = rs.TEXT_BLOCK, 7
    try:
        assert [t for b in rs.terms(text) for t in b] == whole == [t.encode() for t in cut(text.decode())]
    finally:
        rs.TEXT_BLOCK = rs_block


# -------------------------------------------------------------------- quality

def test_features_of_blocks_and_edges(monkeypatch):
    assert not ql.features(None).any() and not ql.features("").any()
    text = prose(random.Random(1), vocabulary(random.Random(2), 300), 3000)
    whole = dict(zip(ql.FEATURES, ql.features(text)))
    monkeypatch.setattr(ql, "BLOCK_CHARS", 1000)
    parts = dict(zip(ql.FEATURES, ql.features(text)))
    for name in set(ql.FEATURES) - {"distinct_words", "top_word", "repeated_next"}:     # per block by definition
        assert whole[name] == pytest.approx(parts[name], rel=1e-9), name
    by_hand = dict(zip(ql.FEATURES, ql.features("AB cd!! 12 ***\nx y y.")))
    assert by_hand["upper_words"] == pytest.approx(1 / 7) and by_hand["letterless_words"] == pytest.approx(2 / 7)
    assert by_hand["marked_words"] == pytest.approx(1 / 7) and by_hand["digit"] == pytest.approx(2 / 21)
    assert by_hand["exclaim"] == pytest.approx(2 / 21) and by_hand["line_breaks"] == pytest.approx(1 / 21)
    assert np.isfinite(ql.features("x" * 3_000_000 + "\ud800")).all()


def test_lookup_tables_hold_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(ql.FEATURES)))
    y = ((x[:, 2] > .5) ^ (x[:, 7] > .5)).astype(float)             # no feature alone says anything
    m = ql.train(x[:3000], y[:3000], .5)
    assert (2, 7) in m.pairs
    p = ql.scores(m, x[3000:])
    assert ((p > .5) == y[3000:]).mean() > .9
    by_hand = m.base + sum(t[np.searchsorted(c, v, "left")] for c, t, v in zip(m.cuts, m.tables, x[0])) + sum(
        t[np.searchsorted(m.pair_cuts[a], x[0, a], "left"), np.searchsorted(m.pair_cuts[b], x[0, b], "left")]
        for (a, b), t in zip(m.pairs, m.pair_tables))
    assert ql.scores(m, x[:1])[0] == pytest.approx(1 / (1 + math.exp(-by_hand)))


def test_scores_follow_the_share_of_the_table():
    rng = np.random.default_rng(2)
    x = rng.random((2000, len(ql.FEATURES)))
    y = (rng.random(2000) < .5).astype(float)
    p = ql.scores(ql.train(x, y, .9), x)
    assert np.average(p, weights=np.where(y == 1, .9, .1)) == pytest.approx(.9, abs=.03)
    assert ql.train(x, np.ones(2000), .9) is None


def test_held_out_accuracy_on_the_test_tables(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = ql.train_on(docs, labels, crc_fold("doc_id", 5) != 0)
    got = (ql.quality(docs, model).join(labels.where(crc_fold("doc_id", 5) == 0).withColumnRenamed("quality", "y"), "doc_id")
           .select("y", "predicted").collect())
    assert len(got) > 50 and sum(r.y == r.predicted for r in got) / len(got) > .95
    assert sum(r.y == 0 and r.predicted == 0 for r in got) / sum(r.y == 0 for r in got) > .8


def test_quality_edges(spark):
    rows = [(1, "good words here."), (2, None), (3, ""), (3, ""), (4, "x" * 400_000), (None, "a b")]
    docs = documents(spark, rows).selectExpr("*", "'s' AS score", "'p' AS PREDICTED", "1 AS x")
    got = ql.quality(docs, None).collect()
    assert {r.score for r in got} == {.5} and {r.predicted for r in got} == {1} and len(got) == 6
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    model = ql.train_on(docs, labels, F.lit(True))
    assert model is not None
    assert len(ql.quality(docs, model).select("score").collect()) == 6
    assert ql.train_on(docs.limit(0), labels, F.lit(True)) is None
    assert ql.quality(docs.limit(0), model).count() == 0
