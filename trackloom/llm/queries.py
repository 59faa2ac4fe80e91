"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontamination, fingerprint, lexical, pii, quality, sharding, simhash, spelling, suffix_dedup, toxicity, warc
from .common import scratch_path, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.render(rows.union(more)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.train_on(docs))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.resolve_revisits(table(spark, sf_dir, "pages")), path)
    read = warc.read_archives(spark, path)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train_on(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def texts_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of ``op2_fingerprints``."""
    return op2_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def texts_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of ``op6_pii``."""
    return op6_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def texts_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of ``op10_sharding``: sizes, checksums, and that the slots of a shard have no gap."""
    placed = op10_sharding(spark, sf_dir)
    shards = placed.groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("full"), (F.countDistinct("slot") == F.count("*")).alias("apart"))
    return placed.join(F.broadcast(shards), "shard").select("doc_id", "size", "text_crc32", "law", "full", "apart", (F.col("shard").between(0, 15)).alias("known"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_fingerprints": op2_fingerprints,
        "op3_decontamination": op3_decontamination,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_chat": op5_chat,
        "op6_pii": op6_pii,
        "op7_bpe": op7_bpe,
        "op8_toxicity": op8_toxicity,
        "op9_warc": op9_warc,
        "op10_sharding": op10_sharding,
        "op11_quality": op11_quality,
        "op12_spelling": op12_spelling,
        "op13_lexical": op13_lexical,
        "texts_edited": texts_edited,
        "texts_base_counts": texts_base_counts,
        "texts_placed": texts_placed,
    }


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
size AS (SELECT item_id, ws, least(len(ws), 13) AS n FROM b WHERE len(ws) > 0),
item AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (SELECT item_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM size)),
place AS (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item) WHERE len(ws) >= n),
win AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM place),
hit AS (SELECT win.doc_id, win.n, win.i, item.item_id FROM win JOIN item ON win.w = item.w AND win.n = item.n),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN named ON d.doc_id = named.doc_id"""

_ESCAPES = "len(regexp_extract_all({0}, '\\\\|<s>|</s>|\\[INST\\]|\\[/INST\\]|\\[GEN\\]|\\[ROLE\\]|\\[SEP\\]|\\[/ROLE\\]'))"

CHAT_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + {_ESCAPES.format('text')} + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 18 + length(role) + {_ESCAPES.format('role')} END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> {5 * k}) & 31 AS INTEGER) + 1, 1)" for k in (3, 2, 1, 0)
)
_DIGIT = "(instr('0123456789abcdef', substr(h, i * 5 + {0}, 1)) - 1)"
_VALUE = " + ".join(f"{_DIGIT.format(k + 1)} * {16 ** (4 - k)}" for k in range(5))

WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
v AS (SELECT page_id, i, CAST({_VALUE} AS BIGINT) AS x FROM (SELECT page_id, h, unnest(range(8)) AS i FROM p)),
b AS (SELECT page_id, string_agg({_BASE32}, '' ORDER BY i) AS payload_digest FROM v GROUP BY page_id),
o AS (SELECT html, max(page_id) AS original FROM p GROUP BY html)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN p.page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> original THEN original END AS refers_to
FROM p JOIN b ON p.page_id = b.page_id JOIN o ON p.html = o.html"""


#: Every 100 bytes, written in hex and cut from pieces of 1,000 bytes; the first of equal ones stays.
SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2198) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS b FROM d)),
start AS (SELECT doc_id, b + i AS p, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, b, h, unnest(range(least(1000, len(h) // 2 - 99))) AS i FROM piece WHERE len(h) >= 200)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM start) WHERE k > 1),
isle AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM again),
span AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM isle) GROUP BY doc_id, g),
part AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM span UNION ALL SELECT doc_id, coalesce(z, 0), len(h) // 2 FROM d LEFT JOIN (SELECT doc_id, max(z) AS z FROM span GROUP BY doc_id) USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS k FROM part JOIN d USING (doc_id) GROUP BY doc_id),
size AS (SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM d JOIN kept USING (doc_id) LEFT JOIN size USING (doc_id)"""

EDITED_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) // 2 AS half, coalesce(lead(t) OVER w, first_value(t) OVER w) AS after FROM d WINDOW w AS (ORDER BY doc_id DESC))
SELECT doc_id, length(t) AS n_chars, sha256(left(t, length(t) - half) || left(after, half)) AS edited_sha256 FROM n"""

#: crc32 by its table: each byte's remainder, eight bits at a time.
_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"
VARIANTS_SQL = f"""
WITH RECURSIVE rem AS (SELECT range AS b, 0 AS k, range AS c FROM range(256) UNION ALL SELECT b, k + 1, {_STEP.format('c')} FROM rem WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM rem WHERE k = 8),
run AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
keyed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: instr('0123456789ABCDEF', h[i]) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 17)),
  lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM (SELECT w, n, hex(encode(doc_id || ':' || w)) AS h FROM run), crc),
word AS (SELECT w AS word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN crc % 31 = 0 THEN left(w, CAST(crc % length(w) AS INT)) || substr(w, CAST(crc % length(w) AS INT) + 2) ELSE w END AS w, n FROM keyed)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
gone AS (SELECT word, i, left(word, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.v = b.v AND a.i = b.i AND a.word <> b.word UNION SELECT word, v FROM gone SEMI JOIN (SELECT word AS v FROM word) USING (v)
  UNION SELECT v, word FROM gone SEMI JOIN (SELECT word AS v FROM word) USING (v)),
best AS (SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS other, max(o.n) AS other_n FROM near JOIN word o ON o.word = other GROUP BY near.word),
led AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM word LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root, form AS next FROM led UNION ALL SELECT way.word, led.word, led.form FROM way JOIN led ON led.word = way.next)
SELECT led.word, form, root, n, n_near, form_n FROM led JOIN way ON way.word = led.word AND way.next IS NULL"""

PLACED_SQL = f"""
WITH RECURSIVE rem AS (SELECT range AS b, 0 AS k, range AS c FROM range(256) UNION ALL SELECT b, k + 1, {_STEP.format('c')} FROM rem WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM rem WHERE k = 8), d AS (SELECT doc_id, string_split(hex(encode(coalesce(text, ''))), '') AS h FROM documents)
SELECT doc_id, len(list_filter(h, lambda x: x <> '')) // 2 + 1 AS size, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: instr('0123456789ABCDEF', h[i]) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 17)),
  lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32, 'key' AS law, true AS "full", true AS apart, true AS known FROM d, crc"""

_TERMS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents), sized AS (SELECT doc_id, len(ts) AS n, ts FROM d WHERE len(ts) > 0),
all_docs AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM sized) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, all_docs GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
hit AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score FROM asked JOIN w USING (term) JOIN tf USING (term), all_docs GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM hit WHERE score > 0) WHERE rank <= 50"""

_FOUND = "regexp_extract_all(coalesce(text, ''), '{0}')"
_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
#: The digits from the right; every second one counts double, less nine over nine.
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS.format('x')}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN CAST(c AS INT) * 2 - 9 ELSE CAST(c AS INT) * 2 END)) % 10 = 0"
BASE_COUNTS_SQL = f"""
SELECT doc_id, CAST(len({_FOUND.format('[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')}) AS BIGINT) AS n_email,
  CAST(len(list_filter({_FOUND.format('[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)')}, lambda x: len(list_filter(string_split(x, '.'), lambda y: CAST(y AS HUGEINT) > 255)) = 0)) AS BIGINT) AS n_ip,
  CAST(len(list_filter({_FOUND.format('[0-9](?:[ -]?[0-9])+')}, lambda x: length({_DIGITS.format('x')}) BETWEEN 12 AND 19 AND {_LUHN})) AS BIGINT) AS n_card,
  CAST(len(list_filter({_FOUND.format('[+][0-9][ ().0-9-]+[0-9]')}, lambda x: length({_DIGITS.format('x')}) BETWEEN 9 AND 15)) AS BIGINT) AS n_phone
FROM documents"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the others are tested against plain versions."""
    return {
        "op4_suffix_dedup": SUFFIX_SQL, "texts_edited": EDITED_SQL, "texts_base_counts": BASE_COUNTS_SQL, "texts_placed": PLACED_SQL,
        "op3_decontamination": DECONTAMINATION_SQL, "op5_chat": CHAT_SQL, "op9_warc": WARC_SQL, "op12_spelling": VARIANTS_SQL, "op13_lexical": SEARCH_SQL,
    }
