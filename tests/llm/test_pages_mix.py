"""Text extraction (op2), decontamination (op5), mixing (op1), archives (op10) and the pipeline."""

import gzip
import hashlib
import os
import random
import re
import tempfile

import numpy as np
import pytest

import corpus_pipeline
from clickpulse.llm import decontaminate as dc
from clickpulse.llm import mixing as mx
from clickpulse.llm import warc
from clickpulse.llm.common import table
from clickpulse.llm.html_text import Page, main_text, match_trees
from clickpulse.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, prose, vocabulary


# -------------------------------------------------------------------- html

def text_of(source):
    return " ".join(t for _, t in Page(source).kept())


@pytest.mark.parametrize("source, want", [
    ("", ""),
    ("plain", "plain"),
    ("<p>a<p>b", "a b"),
    ("<p>a <b>b</b>c<br>d</p>", "a bc d"),
    ("<p>&lt;b&gt; &amp;amp; &eacute;&#233;&#x41; &copy 5</p>", "<b> &amp; ééA © 5"),
    ("<p>a\n\t b c</p>", "a b c"),
    ("<script>var x='</p>';</script><style>p{}</style><p>x</p>", "x"),
    ("<title>t</title><nav>n</nav><header>h</header><p>x</p><footer>f</footer><aside>s</aside>", "x"),
    ("<div class='ad'>buy</div><div class=\"cookie-notice\">ok</div><form>f<input></form><p>x", "x"),
    ("<div id=comments><p>first!</p></div><div role=navigation>n</div><p>x", "x"),
    ("<p>out</p><article><h1>T</h1><p><b>one.<br><p>two</p><div class=share>s</div></article><p>out", "T one. two"),
    ("<main><article><p>in</p></article><section class='comments'><article>no</article></section></main>", "in"),
    ("<ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul><p>x</p>", "x"),
    ("<ul><li>one <a href=x>link</a></li><li>two</li></ul>", "one link two"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>x<!-- c > --></p><!-- open", "x"),
    ("<p>1 < 2 and <3</p>", "1 < 2 and <3"),
    ("<P CLASS=X>Up</P><textarea><p>no</p></textarea>", "Up"),
    ("</div></p><p>x</b></p>", "x"),
    ("<p>x</p><script>never closed", "x"),
])
def test_page_text(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize("source, want", [
    ("<article class='post no-sidebar'><p>x</p><div class=share>s</div></article><p>out", "x"),
    ("<p>out</p><div class='content comment-open'><article><p>main text</p></article></div>", "main text"),
    ("<body><form id=f class=search><main><p>main text</p></main></form><p>out</body>", "main text"),
    ("<div id=search-results><p>a</p><p>b</p></div>", "a b"),
    ("<div id=post><p>the long post</p></div><div class=comments><article>c</article></div>", "the long post c"),
    ("<div data-id='form-3'>a</div><div title='hidden gems'>b</div><div data-hidden=false>c</div><p>d", "a b c d"),
    ("<div data-x=\"class='ad'\">a</div><p class=a class=ad>b</p><p hidden>c</p>", "a b"),
    ("<p>a<span class=ad>b</span>c</p>", "ac"),
])
def test_class_words_are_hints(source, want):
    assert text_of(source) == want


def test_marked_text_is_used_where_nothing_else_varies(spark):
    rng = random.Random(16)
    words = vocabulary(rng, 300)
    rows = []
    for k in range(8):
        body = prose(rng, words, rng.randint(4, 20))
        rows.append((k, f"https://a.example.com/{k}", "<body><div>Home News</div><div class='content comment-open'>"
                     f"<p>{body}</p><p>Subscribe</p></div><div>(c) site</div></body>", body))
        rows.append((100 + k, f"https://b.example.com/{k}", "<body><div>Home News</div><div class=content>"
                     f"<p>{body}</p></div><div class=comments><p>{prose(rng, words, 9)}</p></div></body>", body))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in main_text(pages).collect()} == {r[0]: r[3] for r in rows}


def test_deep_and_long_pages():
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    words = " ".join(str(i) for i in range(200_000))
    assert text_of(f"<article><p>{words}</p></article>") == words


def test_match_trees_keeps_order_and_is_largest():
    def brute(a, b):
        kids = lambda t, i: [k for k, (p, _) in enumerate(t) if p == i]

        def size(i, j):
            if a[i][1] != b[j][1]:
                return 0
            x, y = kids(a, i), kids(b, j)
            m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for p in range(len(x)):
                for q in range(len(y)):
                    m[p + 1][q + 1] = max(m[p][q + 1], m[p + 1][q], m[p][q] + size(x[p], y[q]))
            return 1 + m[-1][-1]
        return size(0, 0)

    rng = random.Random(1)
    for _ in range(60):
        trees = []
        for _ in range(2):
            t = [(-1, "r")]
            for i in range(1, rng.randint(1, 14)):
                t.append((rng.randrange(i), rng.choice("abc")))
            trees.append(t)
        a, b = trees
        found = match_trees(a, b)
        assert len(found) == brute(a, b) and len(set(found.values())) == len(found)
        assert all(a[i][1] == b[j][1] and (i == 0) == (j == 0) for i, j in found.items())
        assert all(found[a[i][0]] == b[j][0] for i, j in found.items() if i)


def site_pages(rng, words, host, n, first):
    rows = []
    for k in range(n):
        body = [prose(rng, words, rng.randint(5, 30)) for _ in range(rng.randint(1, 4))]
        source = (f"<html><body><div class=top>Welcome to {host}</div><div class=body><h2>{prose(rng, words, 3)} {k}</h2>"
                  + "".join(f"<p>{b}</p>" for b in body)
                  + f"</div><div class=b2>All rights at {host}</div></body></html>")
        rows.append((first + k, f"https://{host}/p/{k}", source,
                     " ".join([re.search("<h2>(.*)</h2>", source)[1], *body])))
    return rows


def test_wrapper_finds_template_of_host(spark):
    rng = random.Random(2)
    words = vocabulary(rng, 300)
    rows = site_pages(rng, words, "a.example.com", 9, 0) + site_pages(rng, words, "b.example.com", 7, 100)
    # copies of one article are not a template, nor is a host with few pages
    copy = "<body><div class=t>same title</div><p>same text</p></body>"
    rows += [(200 + k, f"https://c.example.com/{k}", copy, "same title same text") for k in range(6)]
    rows += [(300, "https://d.example.com/", "<div>x</div><p>y</p>", "x y"), (301, None, "<p>n</p>", "n"),
             (302, "no host", "<p>m</p>", "m"), (303, "https://a.example.com/z", None, ""),
             (304, "https://a.example.com/z", "", ""), (0, "https://a.example.com/p/0", rows[0][2], rows[0][3])]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = main_text(pages.selectExpr("*", "'q' AS text", "'w' AS template", "'h' AS host")).collect()
    assert len(got) == len(rows)
    want = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert main_text(pages.limit(0)).count() == 0


def test_template_among_like_siblings(spark):
    # unmarked siblings of one signature, a constant paragraph among varying ones, numbered columns, table cells
    rng = random.Random(15)
    words = vocabulary(rng, 300)
    layouts = {
        "divs": "<body><div>Home News</div><div>{0}</div><div>(c) site</div></body>",
        "paras": "<body><p>{0}</p><p>{1}</p><p>Subscribe to our letter</p></body>",
        "cols": "<body><div class=col-1>Menu here</div><div class=col-2>{0}</div></body>",
        "cells": "<body><table><tr><td>Left menu<td><p>{0}<p>{1}</table></body>",
    }
    rows = []
    for h, (name, layout) in enumerate(layouts.items()):
        for k in range(8):
            body = [prose(rng, words, rng.randint(4, 20)) for _ in range(2)]
            rows.append((h * 100 + k, f"https://{name}.example.com/{k}", layout.format(*body),
                         " ".join(body[:2 if "{1}" in layout else 1])))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in main_text(pages).collect()} == {r[0]: r[3] for r in rows}


def test_pages_of_the_test_tables(spark):
    import html as h
    got = QUERIES["op2_html_text"](spark, SF_SMALL).join(table(spark, SF_SMALL, "pages").drop("url"), "page_id")
    for r in got.collect():
        inner = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        inner = re.sub(r"</?(p|br|h1)>", " ", inner)
        assert r.text == " ".join(h.unescape(re.sub(r"<[^>]+>", "", inner)).split())


# --------------------------------------------------------- decontamination

def align_brute(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (dc.MATCH if a[i] == b[j] else dc.MISMATCH),
                                  h[i][j + 1] + dc.GAP, h[i + 1][j] + dc.GAP)
            best = max(best, h[i + 1][j + 1])
    return best


def test_alignment_scores():
    rng = np.random.default_rng(3)
    for _ in range(80):
        a, b = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 25))
        s, at, row = dc.align(a, b)
        assert s == align_brute(a.tolist(), b.tolist())
        if s:
            assert a[row] == b[at]


def leaky_corpus(rng):
    words = vocabulary(rng, 500) + ["the", "of", "and"] * 60
    items = [(k, prose(rng, words, rng.randint(15, 50))) for k in range(25)]
    items += [(90, "two words"), (91, ""), (92, None), (93, items[0][1])]
    rows = []
    for i in range(120):
        ws = prose(rng, words, rng.randint(30, 300)).split()
        if i % 4 == 0:
            leak = rng.choice(items[:25])[1].split()
            for k in range(rng.choice([7, 9, 11, 100]), len(leak), 9):      # edited copies
                leak[k] = rng.choice(words)
            cut = rng.randrange(len(ws))
            ws[cut:cut] = leak
        rows.append((i, " ".join(ws)))
    return rows, items


def test_contamination_against_brute_force(spark):
    rows, items = leaky_corpus(random.Random(4))
    want = {}
    for i, t in rows:
        for k, q in items:
            a, b = dc.words(q), dc.words(t)
            if a and (s := align_brute(a, b)) >= dc.THRESHOLD * dc.MATCH * len(a):
                want[i, k] = s / (dc.MATCH * len(a))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (1 << 24, 700):            # one block, and a test set larger than a block
        got = dc.contaminated_passages(documents(spark, rows), bench, block_chars=block).collect()
        assert {(r.doc_id, r.item_id): r.score for r in got} == pytest.approx(want)
    assert len(want) >= 30
    words = {i: dc.words(t) for i, t in rows}
    item = {k: dc.words(q) for k, q in items}
    for r in got:
        span = words[r.doc_id][r.first_word:r.last_word + 1]
        assert align_brute(item[r.item_id], span) == pytest.approx(r.score * dc.MATCH * len(item[r.item_id]))
    kept = dc.decontaminate(documents(spark, rows), bench, block_chars=700)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_evenly_edited_copies_are_found(spark):
    # no copy keeps six words in a row; with every 2nd word an insertion not even two
    rng = random.Random(14)
    words = vocabulary(rng, 700)
    items, rows = [], []
    for k, (m, step, kind) in enumerate((m, step, kind) for m in (5, 16, 39, 59) for step in (3, 4, 5, 6)
                                        for kind in ("replace", "insert", "drop")):
        items.append((k, prose(rng, words, m)))
        copy = []
        for j, w in enumerate(items[-1][1].split()):
            edit = j % step == step - 1
            copy += [f"new{k}x{j}"] if edit and kind == "replace" else [] if edit and kind == "drop" else [w]
            copy += [f"new{k}x{j}"] if edit and kind == "insert" else []
        rows.append((k, " ".join([prose(rng, words, 20), *copy, prose(rng, words, 20)])))
        if k % 3 == 0:      # a verbatim copy elsewhere makes the intact grams no rarer than the destroyed ones
            rows.append((1000 + k, items[-1][1]))
    items.append((900, prose(rng, words, 30)))
    rows.append((900, " ".join(f"{w} gap{j}" for j, w in enumerate(items[-1][1].split()))))
    items.append((901, "la la la la di la la la"))
    rows.append((901, "la di la x la di la la y la"))
    want = {}
    for i, t in rows:
        for k, q in items:
            a, b = dc.words(q), dc.words(t)
            if (s := align_brute(a, b)) >= dc.THRESHOLD * dc.MATCH * len(a):
                want[i, k] = s / (dc.MATCH * len(a))
    assert all((k, k) in want for k, _ in items)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contaminated_passages(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == pytest.approx(want)


def test_seeds_leave_few_candidates(spark):
    """Pairs of texts and items that share a seed, and that every contaminated pair is among them."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = next(dc._blocks(bench, "item_id", "text", dc.BLOCK_CHARS))
    texts = docs.selectExpr("coalesce(text, '') AS t")
    seeds = dc.choose_seeds(texts, items, dc.THRESHOLD)
    met = {(r.doc_id, items.ids[k]) for r in docs.select("doc_id", "text").collect()
           for k in seeds.hits(items.numbers(r.text))[0].tolist()}
    found = {(r.doc_id, r.item_id) for r in dc.contaminated_passages(docs, bench).collect()}
    assert found and found <= met
    assert len(met) < 0.01 * docs.count() * len(items.ids) + len(found)


def test_short_items_and_other_thresholds(spark):
    """Items of one to seven words, sought by words or by pairs, at several thresholds."""
    rng = random.Random(15)
    words = vocabulary(rng, 12)
    items = [(k, prose(rng, words, k % 7 + 1)) for k in range(21)]
    rows = [(i, prose(rng, words, rng.randint(1, 14))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for threshold in (0.2, 0.5, 0.75, 1.0):
        want = {}
        for i, t in rows:
            for k, q in items:
                a, b = dc.words(q), dc.words(t)
                if (s := align_brute(a, b)) >= threshold * dc.MATCH * len(a):
                    want[i, k] = s / (dc.MATCH * len(a))
        got = dc.contaminated_passages(documents(spark, rows), bench, threshold=threshold).collect()
        assert {(r.doc_id, r.item_id): r.score for r in got} == pytest.approx(want)


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(None, "one two three four five six")], "item_id bigint, text string")
    docs = documents(spark, [(1, None), (2, ""), (None, "x one two three four five six"), (3, "x" * 200_000),
                             (3, "one two three four five six " * 3000)]).selectExpr("*", "1 AS m", "2 AS item_id")
    got = dc.contaminated_passages(docs, bench).collect()
    assert sorted((r.doc_id is None, r.item_id, r.score) for r in got) == [(False, None, 1.0), (True, None, 1.0)]
    assert dc.decontaminate(docs, bench).columns == docs.columns
    assert dc.decontaminate(docs, bench).count() == 3
    assert dc.contaminated_passages(docs, bench.limit(0)).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).count() == 5
    assert dc.contaminated_passages(docs.limit(0), bench).count() == 0


# ------------------------------------------------------------------ mixing

def mix_brute(blocks, a):
    """Earliest deadline first, slot by slot: [(phase, source, block)]."""
    done, out, phase = dict.fromkeys(blocks, 0), [], 0
    while any(done[s] < blocks[s] for s in blocks):
        live = [s for s in blocks if done[s] < blocks[s]]
        total, begin, t = sum(a[s] for s in live), dict(done), 0
        while all(done[s] < blocks[s] for s in live):
            ready = []
            for s in sorted(live):
                k = done[s] - begin[s]
                if k * total // a[s] <= t:
                    ready.append((-(-(k + 1) * total // a[s]), s))
            s = min(ready)[1]
            out.append((phase, s, done[s]))
            done[s] += 1
            t += 1
        phase += 1
    return out


def test_schedule_against_slot_by_slot_simulation():
    rng = random.Random(5)
    for _ in range(80):
        a = {f"s{k}": rng.randint(1, 12) for k in range(rng.randint(1, 6))}
        blocks = {s: rng.randint(1, 40) for s in a}
        want = {(s, b): (p, t) for t, (p, s, b) in enumerate(mix_brute(blocks, a))}
        plan, got = mx.phases(blocks, a), {}
        for s, n in blocks.items():
            for b in range(n):
                k = max(i for i, p in enumerate(plan) if s in p.slots and p.first[s] <= b)
                p = plan[k]
                q, j = divmod(b - p.first[s], len(p.slots[s]))
                got[s, b] = (k, p.start_slot + q * p.period + p.slots[s][j])
        assert got == want


def test_deviation_stays_below_one_block():
    for a in ({"a": 7, "b": 2, "c": 1}, {"a": 475, "b": 200, "c": 325}, {"x": 1}):
        slots, total = mx.edf_period(a), sum(a.values())
        for s, at in slots.items():
            got = np.cumsum(np.isin(np.arange(total), at))
            assert (np.abs(got - np.arange(1, total + 1) * a[s] / total) < 1).all()


def test_small_integer_weights_are_exact(spark):
    assert mx.integer_weights({"a": 1, "b": 2, "c": 4}) == {"a": 1, "b": 2, "c": 4}
    assert mx.integer_weights({"a": 0.99999, "b": 1e-5}) == {"a": 99_999, "b": 1}
    assert mx.integer_weights({"a": 1 / 3, "b": 2 / 3}) == {"a": 1, "b": 2}
    rough = mx.integer_weights({"a": 2 ** 0.5, "b": 1e-7, "c": 3 ** 0.5})
    assert abs(sum(rough.values()) - mx.MAX_PERIOD) <= 3 and rough["b"] == 1
    rows = [(i, "t", None, "abcccbc"[i % 7]) for i in range(7000)]
    got = mx.mix_sources(documents(spark, rows), {"a": 1, "b": 2, "c": 4}, block_rows=1).collect()
    seen = dict.fromkeys("abc", 0)
    for t, r in enumerate(sorted(got, key=lambda r: r.mix_position), 1):
        seen[r.mix_class] += 1
        assert r.mix_phase or all(abs(seen[s] - t * w / 7) < 1 for s, w in zip("abc", (1, 2, 4)))


def test_mix_rows(spark):
    rows = [(i, "t", None, random.Random(i).choice(["x", "x", "x", "y", "z", None])) for i in range(700)]
    docs = documents(spark, rows + [(5, "t", None, "x"), (5, "t", None, "x"), (None, "t", None, "y")])
    docs = docs.selectExpr("*", "1 AS phase", "2 AS j", "3 AS c")
    weights, size = {"x": 0.5, "y": 0.3, "*": 0.2}, 8
    got = mx.mix_sources(docs, weights, block_rows=size).collect()
    assert len(got) == 703 and len({r.mix_position for r in got}) == 703
    counts = {}
    for r in got:
        assert r.mix_class == (r.source if r.source in weights else "*")
        counts[r.mix_class] = counts.get(r.mix_class, 0) + 1
        assert r.mix_position // size == r.mix_slot
    blocks = {s: -(-n // size) for s, n in counts.items()}
    order = mix_brute(blocks, mx.integer_weights(weights))
    assert {(r.mix_phase, r.mix_class, r.mix_block): r.mix_slot for r in got} == {k: t for t, k in enumerate(order)}
    for s in counts:        # inside a class the rows come by md5 of the id
        mine = [hashlib.md5(("null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()
                for r in sorted(got, key=lambda r: r.mix_position) if r.mix_class == s]
        assert mine == sorted(mine)
    assert mx.mix_sources(docs.limit(0), weights).count() == 0


def test_mix_query_is_a_permutation(spark):
    got = QUERIES["op1_mix"](spark, SF_SMALL).collect()
    assert len(got) == table(spark, SF_SMALL, "documents").count() == len({r.mix_position for r in got})


# ---------------------------------------------------------------- archives

def page_rows():
    rng = random.Random(6)
    words = vocabulary(rng, 80)
    bodies = [prose(rng, words, rng.randint(0, 60)) for _ in range(40)] + ["é" * 60, "WARC/1.1\r\n\r\n" * 30]
    rows = [(i * 7 % 300 - 20, f"https://h/{i}", rng.choice(bodies)) for i in range(300)]
    rows += [(900, None, None), (901, "http://x/\r\ninjected: 1", ""), (902, " spaced ", "z" * 500_000),
             (None, "https://null/1", bodies[-1]), (None, "https://null/2", "only here " * 20),
             (950, "https://rep/a", "twice " * 30), (950, "https://rep/a", "twice " * 30)]
    return rows


def brute_records(rows):
    first = {}
    for i, _, t in rows:
        p = (t or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out, answered = [], set()
    for i, u, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        p = (t or "").encode()
        ref = first.get(p) if len(p) >= 100 else None
        revisit = ref is not None and (ref != i or (i, p) in answered)
        answered.add((i, p))
        out.append((i, u, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response",
                    ref if revisit else None, None if revisit else p))
    return out


def archive(spark, pages, **kw):
    folder = tempfile.mkdtemp(prefix="warc-")
    return folder, warc.write_archives(pages, folder + "/out", **kw).collect()


def test_archives_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS shard", "2 AS ref")
    folder, manifest = archive(spark, pages, shard_bytes=40_000, file_bytes=3000)
    got = warc.read_archives(spark, folder + "/out").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=key) \
        == sorted(brute_records(rows), key=key)
    assert len({m.shard for m in manifest}) > 3 and max(m.seq for m in manifest) > 0
    for m in manifest:
        data = open(f"{folder}/out/{m.file}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (m.bytes, m.sha256)
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") == m.records


def test_archives_are_deterministic_and_retries_harmless(spark):
    rows = page_rows()
    schema = "page_id bigint, url string, html string"
    files = []
    for n, seed in ((1, 1), (7, 2)):
        random.Random(seed).shuffle(rows)
        folder, manifest = archive(spark, spark.createDataFrame(rows, schema).repartition(n),
                                   shard_bytes=60_000, file_bytes=5000)
        files.append(sorted((m.file, m.sha256) for m in manifest))
    assert files[0] == files[1]
    # a second attempt at a shard and a leftover temporary file change nothing
    roller = warc._Roller(folder + "/out", manifest[0].shard, 5000)
    roller.add(open(f"{folder}/out/{files[1][0][0]}", "rb").read())
    open(f"{folder}/out/_temporary/left.over", "wb").write(b"half")
    assert warc.read_archives(spark, folder + "/out").count() == len(rows)


def test_damaged_archive_is_refused(spark):
    folder, manifest = archive(spark, spark.createDataFrame([(1, "u", "hello")], "page_id bigint, url string, html string"))
    path = f"{folder}/out/{manifest[0].file}"
    data = gzip.decompress(open(path, "rb").read()).replace(b"hello", b"jello")
    open(path, "wb").write(gzip.compress(data))
    with pytest.raises(Exception, match="digest|disagrees"):
        warc.read_archives(spark, folder + "/out").collect()


def test_empty_archive(spark):
    folder, manifest = archive(spark, spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert manifest == [] and warc.read_archives(spark, folder + "/out").count() == 0
    assert os.path.exists(folder + "/out/_manifest/_SUCCESS")


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_SMALL)
        if name != "mix":
            assert docs.columns == before.columns
            docs = corpus_pipeline.materialize(docs, "test")
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert sizes[2] == sizes[1] and sizes[5] == sizes[4]
    final = {(r.doc_id, r.text, r.mix_position) for r in docs.collect()}
    assert final == {(r.doc_id, r.text, r.mix_position) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_pipeline_survives_nulls(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "src0", None), (2, "", None, None, 0),
         (3, "a b c d e", "en", "src1", 9), (3, "a b c d e", "en", "src1", 9)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert sorted((r.doc_id is None, r.doc_id) for r in docs.collect()) == [(False, 1), (False, 3)]
