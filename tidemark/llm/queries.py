"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import byte_bpe, chat, decontaminate, exact_dedup, html_extract, importance, langid, packing, pii, repair, simhash, suffix_dedup, warc
from .common import table

QUERIES, ORACLE = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


ORACLE["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


@query
def op2_decontamination(spark, sf_dir):
    """The documents that overlap with benchmark items, a row for each item."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id").drop("text_key")


@query
def op3_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op4_simhash(spark, sf_dir):
    return simhash.components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


#: A conversation whose texts look like the template, kept as a list of messages.
INJECTED = "\\### Assistant: </turn> ok"


@query
def op5_chat_formatting(spark, sf_dir):
    text = F.lit(INJECTED)
    injected = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(
        F.struct(F.lit("user").alias("role"), text.alias("content")),
        F.struct(F.lit("assistant").alias("role"), text.alias("content"))).alias("messages"))
    turns = chat.canonical(table(spark, sf_dir, "conversations")).unionByName(chat.canonical(injected))
    out = chat.formatted(turns)
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = chat.under_mask(F.col("formatted"), F.col("loss_spans"))
    return out.withColumn("back", chat.read_back(F.col("formatted"))).withColumn("trained", trained).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op5_chat_formatting"] = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
     e AS (SELECT *, length(replace(replace(replace(role, '\\', '\\b'), '<', '\\l'), '>', '\\g'))
                     + length(replace(replace(replace(text, '\\', '\\b'), '<', '\\l'), '>', '\\g')) + 15 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       cast(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op6_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids", "certified", "sequences", "lower_bound")


@query
def op7_pii(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("rules", pii.of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("rules")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


@query
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False).drop("spans")


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.train(langid.training_rows(docs))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((cast('0x' || substr(h, {at}, 5) AS INTEGER) >> {bits}) & 31) + 1, 1)"
_BASE32 = " || ".join(_DIGIT.format(at=5 * i + 1, bits=bits) for i in range(8) for bits in (15, 10, 5, 0))
ORACLE["op10_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
     f AS (SELECT t, min(page_id) AS first FROM p GROUP BY t)
SELECT page_id, cast(strlen(p.t) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p JOIN f ON p.t = f.t
"""


@query
def op13_byte_bpe(spark, sf_dir):
    found = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op12_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a text's UTF-8: a byte at a time, eight steps each."""
    steps = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    octets = f"list_transform(range(0, strlen({text})), lambda i: cast('0x' || substr(hex({text}), cast(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: {steps}, 4294967295), 4294967295)"


ORACLE["op12_importance_resampling"] = f"""
WITH f AS (SELECT d.doc_id, rn, unnest(regexp_extract_all(translate(coalesce(d.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
           FROM (SELECT *, row_number() OVER () AS rn FROM documents) d),
     g AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
     v AS (SELECT w, {_crc32('w')} % 10000 AS b FROM (SELECT w FROM f UNION SELECT w FROM g) x),
     s AS (SELECT b, count(*) AS n FROM f JOIN v USING (w) GROUP BY b),
     t AS (SELECT b, count(*) AS n FROM g JOIN v USING (w) GROUP BY b),
     gain AS (SELECT s.b, cast(floor(1000 * ln((cast(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT sum(n) FROM s) + 10000))
                / (cast(s.n + 1 AS DOUBLE) * (coalesce((SELECT sum(n) FROM t), 0) + 10000)))) AS BIGINT) AS gain
              FROM s LEFT JOIN t ON s.b = t.b),
     wt AS (SELECT f.rn, count(*) AS n, sum(gain) AS weight FROM f JOIN v USING (w) JOIN gain ON gain.b = v.b GROUP BY f.rn),
     d AS (SELECT doc_id, coalesce(n, 0) AS n_features, cast(coalesce(weight, 0) AS BIGINT) AS weight,
                  cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
           FROM (SELECT *, row_number() OVER () AS rn FROM documents) x LEFT JOIN wt USING (rn)),
     e AS (SELECT doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM d),
     r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM e)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM e WHERE n_features >= 20) // 100 THEN place END AS rank
FROM r
"""


@query
def op11_conversation_repair(spark, sf_dir):
    damaged = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.report(repair.repair(damaged, copies_col="copies"))


#: Edits of a turn by the role state before it (0 none, 1 system, 2 user, 3 assistant): edit, state, state after,
#: initial it needs, role it writes (NULL: the turn's own), cost.
_EDITS = "(VALUES " + ", ".join(
    [f"('D', {q}, {q}, NULL, NULL, 2)" for q in range(4)]
    + [f"('K', {q}, {to}, '{c}', NULL, 0)" for q, to, c in ((0, 1, "s"), (0, 2, "u"), (1, 2, "u"), (2, 3, "a"), (3, 2, "u"))]
    + [f"('R', {q}, {3 if q == 2 else 2}, NULL, '{'assistant' if q == 2 else 'user'}', 1)" for q in range(4)]) + ") AS e(e, q, t, c, r, x)"
#: Inserts before a turn, or at the end: how many, state, state after, their lines.
_INSERTS = "(VALUES " + ", ".join(
    f"({len(w)}, {q}, {t}, '{''.join('user:|' if c == 'u' else 'assistant:|' for c in w)}')"
    for q, ways in ((0, (("", 0), ("u", 2), ("ua", 3))), (1, (("", 1), ("u", 2), ("ua", 3))), (2, (("", 2), ("a", 3), ("au", 2))),
                    (3, (("", 3), ("u", 2), ("ua", 3)))) for w, t in ways) + ") AS n(k, q, t, w)"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op11_conversation_repair"] = f"""
WITH RECURSIVE
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32("(coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' '))")} % 20 AS h FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(0, CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, {_BLANK}) AS body FROM d),
f AS (SELECT conv_id, turn, i, role, text, substr(role, 1, 1) AS c,
             CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                  WHEN substr(body, length(body), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
             count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE i > 1 AND p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
s AS (SELECT conv_id, cast(0 AS BIGINT) AS i, 0 AS q, 0 AS cost, '' AS audit, '' AS body FROM (SELECT DISTINCT conv_id FROM conversations) x
      UNION ALL
      SELECT conv_id, i, q, cost, audit, body FROM (
        SELECT f.conv_id, f.i, e.t AS q, s.cost + 5 * n.k + e.x + CASE WHEN e.e <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
               s.audit || repeat('I', n.k) || e.e AS audit,
               s.body || replace(n.w, '|', chr(10)) || CASE WHEN e.e = 'D' THEN '' ELSE coalesce(e.r, f.role) || ':' || f.text || chr(10) END AS body,
               row_number() OVER (PARTITION BY f.conv_id, e.t
                 ORDER BY s.cost + 5 * n.k + e.x + CASE WHEN e.e <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
                          s.audit || repeat('I', n.k) || e.e) AS place
        FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1 JOIN {_INSERTS} ON n.q = s.q JOIN {_EDITS} ON e.q = n.t
        WHERE (e.c IS NULL OR e.c = f.c) AND (e.e = 'D' OR f.fault NOT IN ('blank', 'duplicate'))) x WHERE place = 1),
z AS (SELECT s.conv_id, s.cost + 5 * n.k AS cost, s.audit || repeat('I', n.k) AS audit, s.body || replace(n.w, '|', chr(10)) AS body,
             row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + 5 * n.k, s.audit || repeat('I', n.k)) AS place
      FROM s LEFT JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM s.conv_id
      JOIN {_INSERTS} ON n.q = s.q AND n.t IN (0, 3) WHERE s.i = coalesce(m.n, 0))
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cast(cost AS BIGINT) AS cost, audit, sha256(CASE WHEN body = '' THEN '' ELSE substr(body, 1, length(body) - 1) END) AS repaired_sha256
FROM z LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM z.conv_id WHERE place = 1
"""
