"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import chat, decontaminate, divergence, jaccard, langid, lines, mixing, pii, quality, simhash, suffix_tree, urls, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.measured(table(spark, sf_dir, "documents"))
    count = lambda name: F.coalesce(F.col("gone").getField(name), F.lit(0)).cast("long")
    return out.select(F.col("doc.doc_id").alias("doc_id"), count("n_chunks").alias("n_chunks"), count("words").alias("n_words_removed"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is a log in which each row opens a message; its turn is its sequence number."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    events = chat.numbered(rows.unionByName(extra))
    out = chat.render(chat.fold(events))
    turns = chat.parse(F.col("formatted"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = chat.masked(F.col("formatted"), F.col("mask"))
    return out.withColumn("turns", turns).withColumn("loss", loss).select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined.cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_simhash, op3_quality, op4_langid, op5_line_dedup, op6_mixing, op7_suffix_tree, op8_winnowing, op9_chat, op10_urls, op11_divergence, op12_jaccard, op13_whitening)}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = r"'[^\x20\x09-\x0D]+'"

_OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, chr(0)) AS host FROM documents),
w AS (SELECT r, regexp_extract_all(text, {_SPLIT}) AS ws FROM d),
lines AS (SELECT r, host, i, ls[i] AS line FROM (SELECT r, host, string_split(text, chr(10)) AS ls FROM d), LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)),
norm AS (SELECT r, host, i, line, len(regexp_extract_all(line, {_SPLIT})) AS n, array_to_string(regexp_extract_all({_LOWER.replace("text", "line")}, {_SPLIT}), ' ') AS plain FROM lines WHERE regexp_matches(line, {_SPLIT})),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM norm GROUP BY r),
sig AS (SELECT r, host, list_sort(list(DISTINCT plain)) AS own FROM norm GROUP BY r, host),
freq AS (SELECT norm.host, plain, count(DISTINCT own) AS n FROM norm JOIN sig USING (r) GROUP BY norm.host, plain),
total AS (SELECT host, count(DISTINCT own) AS docs FROM sig GROUP BY host),
gone AS (SELECT norm.r, sum(norm.n) AS removed FROM norm JOIN freq USING (host, plain) JOIN total USING (host) WHERE freq.n > 20 AND freq.n > docs * 0.02 GROUP BY norm.r),
win AS (SELECT r, i, array_to_string(ws[i:i+7], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 6)) AS i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_rep FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - removed_words >= n_words * 0.3 AS kept FROM m
"""

_OP6 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPLIT}))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, chr(0) || sha256(coalesce(text, '')))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w, 3 * source_size AS cap FROM s),
o AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::BIGINT AS l, (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::BIGINT AS wl FROM w
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * wl <= w * l AS is_full FROM o),
v AS (SELECT l, wl FROM f WHERE NOT is_full ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (SELECT f.source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE (w * v.l)::DOUBLE / v.wl::DOUBLE END AS target FROM f LEFT JOIN v ON true),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget, (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken FROM e
"""

_W8 = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_OP8 = rf"""
WITH it AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, {_W8}) AS ws FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, k, array_to_string(ws[i:i+k-1], ' ') AS g FROM (SELECT item, ws, least(len(ws), 10) AS k FROM it WHERE len(ws) > 0), LATERAL (SELECT unnest(range(1, len(ws) - k + 2)) AS i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_W8}) AS ws FROM documents),
g AS (SELECT r, k, i, array_to_string(ws[i:i+k-1], ' ') AS g FROM d, (SELECT DISTINCT k FROM win), LATERAL (SELECT unnest(range(1, len(ws) - k + 2)) AS i)),
m AS (SELECT r, g.k, i, item FROM g JOIN win ON g.k = win.k AND g.g = win.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, k, i FROM m)) GROUP BY r),
x AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN x USING (r)
"""


def _escaped(c: str) -> str:
    out = f"replace({c}, '\\', '\\\\')"
    for x in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
        out = f"replace({out}, '{x}', '{x[0]}\\{x[1:]}')"
    return out


_OP9 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat.OPEN) + len(chat.CLOSE) + 2} + length(replace({_escaped("role")}, chr(10), '\n')) + length({_escaped("text")}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

_OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER.replace("text", "coalesce(text, '')")} AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, k.term, k.n, coalesce(o.c, 0) AS c FROM g JOIN k ON g.lang = k.lang LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
s AS (SELECT *, sum(c) OVER w AS own, count(*) OVER w AS v, sum(n) OVER w AS every FROM c WINDOW w AS (PARTITION BY lang, source)),
p AS (SELECT lang, source, term, c, (1 + (1000000000::HUGEINT * (c + 1)) // (own + v))::BIGINT AS p, (1 + (1000000000::HUGEINT * (n + 1)) // (every + v))::BIGINT AS q FROM s),
m AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""

_OP12 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.replace("text", "coalesce(text, '')")}, {_SPLIT}) AS ws FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT r, r AS o FROM d UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.o = l.a)
SELECT x.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN d x ON x.r = reach.r JOIN d y ON y.r = reach.o LEFT JOIN n ON n.r = reach.r GROUP BY reach.r, x.doc_id, n.n
"""

ORACLE = {"op3_quality": _OP3, "op6_mixing": _OP6, "op8_winnowing": _OP8, "op9_chat": _OP9, "op11_divergence": _OP11, "op12_jaccard": _OP12}
