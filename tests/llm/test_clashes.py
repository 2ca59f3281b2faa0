"""Input columns named like the operators' working columns, odd id types, long and unclosed markup."""

import datetime
import decimal
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickpulse.llm.common import shielded
from clickpulse.llm.decontaminate import contaminated_passages, decontaminate
from clickpulse.llm.exact_dedup import exact_dedup
from clickpulse.llm.html_text import Page, main_text
from clickpulse.llm.language_id import identify, train, training_rows
from clickpulse.llm.line_dedup import line_dedup
from clickpulse.llm.mixing import mix_sources
from clickpulse.llm.quality import quality
from clickpulse.llm.simhash import simhash_dedup
from clickpulse.llm.toxicity import toxicity
from tests.llm.helpers import documents, prose, vocabulary

NAMES = ["__maybe", "__copy", "__hash", "__n", "__order", "__tie", "__rank", "__c", "__at", "__k", "__bucket", "__p",
         "__host", "__b", "__hits", "__keep", "__id", "kept__n"]
ITEM = prose(random.Random(1), vocabulary(random.Random(2), 200), 30)


def odd_docs(spark):
    rng = random.Random(3)
    words = vocabulary(rng, 80)
    rows = [(k, prose(rng, words, 20), "en", "s%d" % (k % 3)) for k in range(12)]
    rows += [(20, rows[0][1], "en", "s0"), (21, None, None, None), (22, ITEM, "fr", "s1")]
    df = documents(spark, rows)
    return df.select("*", *[F.concat(F.lit(n + " of "), F.coalesce("doc_id", F.lit(-1))).alias(n) for n in NAMES])


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")


OPERATORS = {
    "exact_dedup": lambda s, d: exact_dedup(d),
    "line_dedup": lambda s, d: line_dedup(d),
    "simhash_dedup": lambda s, d: simhash_dedup(d),
    "mix_sources": lambda s, d: mix_sources(d, {"s0": 1, "s1": 2, "*": 1}, block_rows=2),
    "identify": lambda s, d: identify(d, None),
    "main_text": lambda s, d: main_text(d.withColumns({"url": F.lit("http://a.b/c"), "html": F.col("text")})),
    "decontaminate": lambda s, d: decontaminate(d, benchmark(s)),
    "toxicity": lambda s, d: toxicity(d, None),
    "quality": lambda s, d: quality(d, None),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_working_columns_keep_the_users_values(spark, name):
    docs = odd_docs(spark)
    got = OPERATORS[name](spark, docs)
    assert [c for c in got.columns if c in NAMES] == NAMES
    rows = got.select("doc_id", *NAMES).collect()
    assert len(rows) >= 13
    for r in rows:
        assert [r[n] for n in NAMES] == [f"{n} of {r.doc_id}" for n in NAMES]


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_keep_the_users_values(spark, stage, tmp_path):
    docs = odd_docs(spark)
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert got.columns[:len(docs.columns)] == docs.columns
    for r in got.collect():
        assert [r[n] for n in NAMES] == [f"{n} of {r.doc_id}" for n in NAMES]
    assert stage != "decontamination" or 22 not in {r.doc_id for r in got.select("doc_id").collect()}


def test_shield_renames_arguments_too(spark):
    df = spark.createDataFrame([(1, "a")], "__id bigint, __text string")
    run = shielded(lambda d, id_col, text_col="t": d.select(id_col, F.upper(text_col).alias("up"), text_col))
    got = run(df, "__id", text_col="__text")
    assert got.columns == ["__id", "up", "__text"] and got.first()["up"] == "A"


@pytest.mark.parametrize("kind,value", [("smallint", 7), ("decimal(10,2)", decimal.Decimal("7.50")),
                                        ("date", datetime.date(2024, 1, 2)), ("string", "x"), ("int", 3)])
def test_item_ids_of_any_type(spark, kind, value):
    items = spark.createDataFrame([(value, ITEM)], f"item_id {kind}, text string")
    got = contaminated_passages(documents(spark, [(5, "before " + ITEM + " after"), (6, "nothing")]), items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(5, value)]


def test_repeated_rows_stay_in_a_fixed_order(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a  b", "y"), (1, "a b", "z")], "doc_id bigint, text string, tag string")
    kept = {tuple(r.tag for r in exact_dedup(docs.repartition(n, F.col("tag"))).where("kept").collect()) for n in (1, 2, 5)}
    assert len(kept) == 1 and len(kept.pop()) == 1


@pytest.mark.parametrize("part", ["<a ", "<", "<!-", "<p", "</", "<a \"", "3 > 2 <b "])
def test_unclosed_markup_takes_linear_time(part):
    begin = time.perf_counter()
    Page("<p>start</p>" + part * (400_000 // len(part)))
    assert time.perf_counter() - begin < 5


@pytest.mark.parametrize("html,text", [
    ("<p>a</p> b <i", "a b <i"), ("<p>a</p> b <!-- c", "a b"), ("<p>a</p> b <!doctype c", "a b"), ("a < b", "a < b"),
    ("<p>a <!-- <b>x</b> y", "a"), ("<p>a</p><!-- x --> c", "a c"), ("<p>a > b <i", "a > b <i")])
def test_text_after_the_last_bracket(spark, html, text):
    page = spark.createDataFrame([(1, None, html)], "page_id bigint, url string, html string")
    assert main_text(page).first().text == text


def test_language_sample_counts_equal_texts_once(spark):
    docs = documents(spark, [(k, "same text here", "en") for k in range(50)] + [(99, "autre texte", "fr"), (98, "x", None)])
    texts, langs = training_rows(docs, "doc_id", "text", "lang", F.lit(True), per_lang=3)
    assert sorted(zip(langs, texts)) == [("en", b"same text here"), ("fr", b"autre texte")]
    assert train(texts, langs, steps=2) is not None
