"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import shared_folder, table
from clickpulse.llm.conversations import damage, repair_report
from clickpulse.llm.decontaminate import contaminated_passages
from clickpulse.llm.exact_dedup import exact_dedup
from clickpulse.llm.html_text import main_text
from clickpulse.llm.language_id import identify, train as train_language, training_rows
from clickpulse.llm.line_dedup import line_dedup
from clickpulse.llm.mixing import OTHER, integer_weights, mix_sources
from clickpulse.llm.quality import quality, train_on as train_quality
from clickpulse.llm.ranked_search import ranked_search
from clickpulse.llm.simhash import simhash_groups
from clickpulse.llm.token_counts import token_counts
from clickpulse.llm.toxicity import toxicity, train_on
from clickpulse.llm.warc import read_archives, write_archives

TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


#: Target weights of the registered mix, in percent: each source has its own; ``*`` are sources beyond these.
MIX_WEIGHTS = {"src0": 20.0, "src1": 10.0, "src2": 10.0, "src3": 5.0, "src4": 5.0, "src5": 2.5,
               **{f"src{k}": 3.25 for k in range(6, 20)}, "*": 2.0}
MIX_BLOCK_ROWS = 64


def op1_mix(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return mix_sources(docs, MIX_WEIGHTS, block_rows=MIX_BLOCK_ROWS)


def op2_html_text(spark, d) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", "n_chars")


def op3_simhash(spark, d) -> DataFrame:
    return (simhash_groups(table(spark, d, "documents").select("doc_id", "text"))
            .select("doc_id", "fingerprint", "component_id"))


def op4_token_counts(spark, d) -> DataFrame:
    import public_tokenizers
    docs = table(spark, d, "documents").select("doc_id", "text")
    return (token_counts(docs, public_tokenizers.path(TOKENIZER), limit=TOKEN_LIMIT)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


def crc_fold(id_col: str, folds: int):
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def op5_decontamination(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return contaminated_passages(docs, table(spark, d, "benchmark"))


def op6_toxicity(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    model = train_on(docs, table(spark, d, "labels"), ~held_out)
    return (toxicity(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "score", "predicted"))


def op7_language(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    model = train_language(*training_rows(docs, "doc_id", "text", "lang", ~held_out))
    return (identify(docs.drop("lang"), model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "lang_pred", "score"))


def op8_line_dedup(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed"))


def op9_exact_dedup(spark, d) -> DataFrame:
    return (exact_dedup(table(spark, d, "documents").select("doc_id", "text"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op10_warc(spark, d) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_archives(table(spark, d, "pages").select("page_id", "url", "html"), folder)
    return (read_archives(spark, folder, payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op11_quality(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False))
    model = train_quality(docs, table(spark, d, "labels"), ~held_out)
    return (quality(docs, model).withColumn("held_out", held_out)
            .select("doc_id", "held_out", "score", "predicted"))


def op12_ranked_search(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return ranked_search(docs, table(spark, d, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op13_conversation_repair(spark, d) -> DataFrame:
    turns = table(spark, d, "conversations")
    return (repair_report(damage(turns), turns)
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_html_text": op2_html_text,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_warc": op10_warc,
    "op11_quality": op11_quality,
    "op12_ranked_search": op12_ranked_search,
    "op13_conversation_repair": op13_conversation_repair,
}

_SQL = {
    "op8_line_dedup": r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line
          FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM parts)),
worded AS (SELECT *, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM lines),
firsts AS (SELECT line, min(struct_pack(d := doc_id, l := line_no)) AS pos, any_value(w) AS w,
                 len(any_value(w)) AS n FROM worded WHERE len(w) > 0 GROUP BY line),
alike AS (SELECT DISTINCT b.line FROM firsts a JOIN firsts b
            ON b.n * 5 >= a.n * 4 AND a.n * 5 >= b.n * 4 AND a.pos < b.pos
            WHERE len(list_intersect(a.w, b.w)) * 9 >= (a.n + b.n) * 4),
gone AS (SELECT k.doc_id, k.line_no FROM worded k JOIN firsts f ON f.line = k.line
         WHERE struct_pack(d := k.doc_id, l := k.line_no) > f.pos
            OR k.line IN (SELECT line FROM alike)),
per AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS r
        FROM gone GROUP BY doc_id)
SELECT p.doc_id, CAST(coalesce(len(p.ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(per.n, 0) AS BIGINT) AS n_removed, coalesce(per.r, '') AS removed
FROM parts p LEFT JOIN per ON per.doc_id = p.doc_id""",
    "op9_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)""",
    "op12_ranked_search": r"""
WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
             lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM documents),
tot AS (SELECT CAST(count(*) FILTER (len(ts) > 0) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
q AS (SELECT item_id, unnest(list_transform(
               regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
               lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS t FROM benchmark),
qf AS (SELECT item_id, t, count(*) AS qn FROM q GROUP BY ALL),
tf AS (SELECT doc_id, t, n, CAST(count(*) AS BIGINT) AS tf
       FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM qf) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, tot GROUP BY t, n_docs),
part AS (SELECT tf.doc_id, tf.t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // l))) AS s
         FROM tf JOIN w USING (t), tot),
scored AS (SELECT item_id, doc_id, CAST(sum(qn * s) AS BIGINT) AS score FROM qf JOIN part USING (t) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 20""",
    # dynamic programming over (rows read, state): 0 start, 1 after s, 2 after u, 3 after a
    "op13_conversation_repair": r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
              lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))),
              CAST(4294967295 AS BIGINT)) % 20 AS kind FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE kind <> 0),
rows_ AS (
  SELECT *, row_number() OVER o AS i, left(role, 1) AS c, lag(left(role, 1)) OVER o AS pc,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
marked AS (SELECT *, blank OR again AS go, CASE WHEN open AND NOT blank AND NOT again THEN 3 ELSE 0 END AS tc FROM rows_),
ins(q, q2, a) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (2, 3, 'I'), (3, 2, 'I'),
                         (0, 3, 'II'), (1, 3, 'II')),
nodes AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, q2 AS q, struct_pack(cost := CAST(3 * length(a) AS BIGINT), audit := a) AS best
  FROM (SELECT DISTINCT conv_id FROM conversations), ins WHERE q = 0
  UNION ALL
  SELECT conv_id, i, q2, min(struct_pack(cost := cost + 3 * length(a), audit := audit || a))
  FROM (SELECT n.conv_id, m.i, n.best.cost + e.cost + CASE WHEN e.op = 'D' THEN 0 ELSE m.tc END AS cost,
               n.best.audit || e.op AS audit, e.q2 AS q1
        FROM nodes n JOIN marked m ON m.conv_id IS NOT DISTINCT FROM n.conv_id AND m.i = n.i + 1
        JOIN (VALUES (0, 'D', '', 0, 4), (1, 'D', '', 1, 4), (2, 'D', '', 2, 4), (3, 'D', '', 3, 4),
                     (0, 'R', '', 2, 3), (1, 'R', '', 2, 3), (2, 'R', '', 3, 3), (3, 'R', '', 2, 3),
                     (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0),
                     (3, 'K', 'u', 2, 0)) e(q, op, c, q2, cost)
          ON e.q = n.q AND (e.op = 'D' OR NOT m.go) AND (e.op <> 'K' OR e.c = m.c))
  JOIN ins ON ins.q = q1 GROUP BY conv_id, i, q2),
last AS (SELECT conv_id, max(i) AS i FROM nodes GROUP BY conv_id),
done AS (SELECT n.conv_id, min(n.best) AS best FROM nodes n JOIN last l ON l.conv_id IS NOT DISTINCT FROM n.conv_id AND l.i = n.i
         WHERE n.q IN (0, 3) GROUP BY n.conv_id),
steps AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM done),
edits AS (SELECT conv_id, p, audit[p] AS op, length(replace(left(audit, p), 'I', '')) AS row_no,
                 length(replace(left(audit, p), 'D', '')) AS place, length(replace(audit, 'D', '')) AS total FROM steps),
texts AS (
  SELECT e.conv_id, string_agg(
           CASE WHEN op = 'K' THEN m.role WHEN (place + total) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN op = 'I' THEN '' ELSE m.text END, chr(10) ORDER BY p) AS t
  FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.row_no
  WHERE op <> 'D' GROUP BY e.conv_id),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (tc > 0) AS truncated,
         count(*) FILTER (pc IS NOT NULL AND pc || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, d.best.cost AS cost, d.best.audit AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM done d LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM d.conv_id""",
    "op10_warc": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n,
                  sha256(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS m FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN m = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m = page_id THEN NULL ELSE m END AS refers_to
FROM r""",
}


def _mix_sql(weights: dict[str, float], rows: int) -> str:
    """The mix by a slot-by-slot simulation: at each slot the released block with the earliest deadline."""
    parts = integer_weights(weights)
    named = ", ".join(f"'{s}'" for s in parts if s != OTHER)
    values = ", ".join(f"('{s}', {a})" for s, a in parts.items())
    return f"""
WITH RECURSIVE w(c, a) AS (VALUES {values}),
docs AS (SELECT doc_id, source, CASE WHEN source IN ({named}) THEN source ELSE '{OTHER}' END AS c FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS r FROM docs),
blocks AS (SELECT c, CAST(max(r) // {rows} + 1 AS BIGINT) AS n FROM ranked GROUP BY c),
k AS (SELECT list(c ORDER BY c) AS cs, list(CAST(a AS BIGINT) ORDER BY c) AS av, list(n ORDER BY c) AS nv
      FROM blocks JOIN w USING (c)),
run AS (
  SELECT CAST(0 AS BIGINT) AS t, 0 AS phase, CAST(0 AS BIGINT) AS t0, list_transform(nv, lambda x: CAST(0 AS BIGINT)) AS d0,
         list_transform(nv, lambda x: CAST(0 AS BIGINT)) AS dn, CAST(NULL AS BIGINT) AS pick,
         CAST(NULL AS INTEGER) AS in_phase, CAST(NULL AS BIGINT) AS block FROM k
  UNION ALL
  SELECT t + 1, CASE WHEN over THEN phase + 1 ELSE phase END, CASE WHEN over THEN t + 1 ELSE t0 END,
         CASE WHEN over THEN dn2 ELSE d0 END, dn2, pick, phase, dn[pick]
  FROM (SELECT *, dn[pick] + 1 = nv[pick] AS over,
               list_transform(range(1, len(dn) + 1), lambda i: CASE WHEN i = pick THEN dn[i] + 1 ELSE dn[i] END) AS dn2
        FROM (SELECT u.* EXCLUDE (pick), list_sort(list_transform(
                list_filter(range(1, len(dn) + 1),
                            lambda i: dn[i] < nv[i] AND ((dn[i] - d0[i]) * total) // av[i] <= t - t0),
                lambda i: {{'due': ((dn[i] - d0[i] + 1) * total + av[i] - 1) // av[i], 'c': cs[i], 'i': i}}))[1].i AS pick
              FROM (SELECT run.* EXCLUDE (in_phase, block), k.*, list_sum(list_transform(range(1, len(dn) + 1),
                           lambda i: CASE WHEN dn[i] < nv[i] THEN av[i] ELSE 0 END)) AS total
                    FROM run, k WHERE list_sum(dn) < list_sum(nv)) u))),
slots AS (SELECT cs[pick] AS c, in_phase, block, t - 1 AS slot FROM run, k WHERE pick IS NOT NULL)
SELECT d.doc_id, d.source, d.c AS mix_class, s.in_phase AS mix_phase, CAST(s.block AS BIGINT) AS mix_block,
       CAST(s.slot AS BIGINT) AS mix_slot, CAST(s.slot * {rows} + d.r % {rows} AS BIGINT) AS mix_position
FROM ranked d JOIN slots s ON s.c = d.c AND s.block = d.r // {rows}"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": _mix_sql(MIX_WEIGHTS, MIX_BLOCK_ROWS), **_SQL}
