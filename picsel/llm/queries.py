"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel.llm import block_names, bpe, chat, decontam, langid, lm, periodic_runs, prefix_trie, quality, sharding, simhash, suffix_dedup, token_store
from picsel.llm.common import stage, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    book = quality.ledger(docs, lexicon=quality.learn(docs, table(spark, sf_dir, "labels")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes("base")).alias("base_failed"), quality.passes().alias("kept"), "failed")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"), width=100).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.train_and_score(table(spark, sf_dir, "documents"), mod=7, held=2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.train_and_predict(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


#: A conversation that holds the template's own control strings.
TRICKY = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.unionByName(spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string"))
    chats = chat.format_chats(rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content")))
    read = chats.withColumn("turns", chat.read_chats(F.col("formatted"))).withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss_mask")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


#: Turns that a rebuilt conversation may take over, and conversations that take them from the same one.
SHARED, FAMILY = 5, 100


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: the first h turns of the first conversation of the hundred, then their own after h; and their ids."""
    h = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    convs = turns.select("conv_id").distinct()
    heads = turns.where((F.col("place") <= SHARED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    taken = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": h}).join(heads, "base").where("place <= h")
    columns = ["conv_id", "place", "content", "chars"]
    return taken.select(*columns).unionByName(turns.where(F.col("place") > h).select(*columns)), convs


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt(stage(prefix_trie.turns(table(spark, sf_dir, "conversations")), "numbered-turns")))


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The contract's planted repetition: in a tenth of the documents the last words are some words over and over."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), tail=repeated_tail)
    # exact quotients; runs are in order of start and period, so of equals the first is taken
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_quality, op3_suffix_dedup, op4_decontamination, op5_sharding, op6_bpe, op7_kneser_ney,
                                    op8_language_id, op9_token_files, op10_chat, op11_prefix_trie, op12_periodic_runs, op13_exact_dedup)}


_ABUSIVE_LIST = ", ".join(f"'{w}'" for w in quality.ABUSIVE)
_PUNCTUATION = quality.PUNCTUATION.decode().replace("'", "''")
_FAILED = " + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(quality.conditions()))

_STEM_LIST = ", ".join(f"left(c, {k})" for k in quality.LENGTHS)
_BARE = f"translate(trim(w, '{_PUNCTUATION}'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_QUALITY_SQL = rf"""
WITH labelled AS MATERIALIZED (
  SELECT DISTINCT doc_id, coalesce(lang, '') AS lang, toxic FROM labels JOIN documents USING (doc_id) WHERE toxic IN (0, 1) AND text IS NOT NULL),
chosen AS (
  SELECT doc_id, lang, toxic FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, toxic ORDER BY md5(doc_id::VARCHAR), doc_id) AS place, (SELECT count(DISTINCT lang) FROM labelled) AS langs
    FROM labelled)
  WHERE place <= CASE WHEN toxic = 1 THEN least({quality.SAMPLE[1]}, {quality.SAMPLE_ALL[1]} // langs) ELSE least({quality.SAMPLE[0]}, {quality.SAMPLE_ALL[0]} // langs) END),
sample AS (SELECT row_number() OVER () AS k, text, lang, toxic FROM (
  SELECT DISTINCT text, c.lang, c.toxic FROM documents d JOIN chosen c ON c.doc_id = d.doc_id AND c.lang = coalesce(d.lang, '') WHERE text IS NOT NULL)),
sample_words AS (SELECT k, lang, toxic, {_BARE} AS c FROM (SELECT k, lang, toxic, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM sample)),
sample_stems AS (SELECT k, lang, toxic, unnest(list_distinct([{_STEM_LIST}])) AS stem FROM sample_words WHERE c <> ''),
lexicon AS MATERIALIZED (
  SELECT DISTINCT stem FROM (
    SELECT lang, stem, count(DISTINCT k) FILTER (WHERE toxic = 1) AS docs, count(*) FILTER (WHERE toxic = 1) AS hits, count(*) AS n
    FROM sample_stems GROUP BY lang, stem)
  JOIN (SELECT lang, count(*) AS texts, sum(toxic) AS toxic_texts FROM sample GROUP BY lang) USING (lang)
  WHERE docs > 0 AND docs * log10(texts / toxic_texts) >= {quality.SURPRISE} AND {quality.RARE} * docs >= toxic_texts AND 20 * hits >= 17 * n),
t AS (
  SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT i + d) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(d) GROUP BY k),
bare AS MATERIALIZED (SELECT k, {_BARE} AS c FROM (SELECT k, unnest(w) AS w FROM t)),
learned AS (SELECT DISTINCT c FROM (SELECT c, unnest([{_STEM_LIST}]) AS stem FROM (SELECT DISTINCT c FROM bare WHERE c <> '')) JOIN lexicon USING (stem)),
l AS (SELECT k, count(*) AS n_learned FROM bare JOIN learned USING (c) GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower, length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs,
         len(list_filter(w, lambda x: lower(trim(x, '{_PUNCTUATION}')) IN ({_ABUSIVE_LIST}))) AS n_abusive,
         coalesce(n_learned, 0) AS n_learned
  FROM t LEFT JOIN covered USING (k) LEFT JOIN l USING (k)),
f AS (SELECT *, ({_FAILED})::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {quality.mask(quality.POLICIES["base"])} <> 0 AS base_failed,
       failed & {quality.mask(quality.POLICIES[quality.CURRENT])} = 0 AS kept, failed
FROM f
"""

# texts as hexadecimal digits, cut into parts that overlap by a window, so that taking a byte does not read the whole text
_SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
parts AS MATERIALIZED (SELECT doc_id, n, pos, substr(h, 2 * pos + 1, 1198) AS part FROM (SELECT doc_id, n, h, unnest(range(0, n, 500)) AS pos FROM d)),
w AS MATERIALIZED (SELECT doc_id, pos + k AS i, substr(part, 2 * k - 1, 2) AS byte, CASE WHEN pos + k <= n - 99 THEN md5(substr(part, 2 * k - 1, 200)) END AS g
                   FROM (SELECT doc_id, n, pos, part, unnest(range(1, least(500, n - pos) + 1)) AS k FROM parts)),
firsts AS (SELECT g, min((doc_id, i)) AS first FROM w WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
again AS (SELECT doc_id, i FROM w JOIN firsts USING (g) WHERE (doc_id, i) > first),
c AS (SELECT doc_id, i, byte, max(CASE WHEN a.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone
      FROM w LEFT JOIN again a USING (doc_id, i)),
s AS (SELECT *, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) = 0 AS first FROM c),
r AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed, sum(first::INT)::BIGINT AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM s GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

_CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS masked,
         sum(length('<turn >' || replace(replace(replace(role, '\', '\b'), '>', '\g'), '<', '\l') || replace(text, '<', '<\') || '</turn>') + 1) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(masked)::BIGINT AS loss_chars, sha256(masked) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM c
"""


# crc32 bit by bit: each character and seven zeros, a step each
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295)")
_TRIE_SQL = f"""
WITH c AS (
  SELECT conv_id, {_CRC} % {SHARED + 1} AS h, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
p AS MATERIALIZED (
  SELECT conv_id, d, to_json(t[1:d])::VARCHAR AS k, CASE WHEN d > 0 THEN to_json(t[1:d - 1])::VARCHAR END AS up,
         CASE WHEN d > 0 THEN length(t[d].text) ELSE 0 END AS chars, d = len(t) AS whole
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT k, any_value(d) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256
  FROM p GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT a.k, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars)::BIGINT AS saved_tokens
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.d <= n.depth LEFT JOIN kids ON kids.k = n.k GROUP BY a.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN n u ON u.k = n.up
"""

_EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB has neither XXH64 with a seed, nor crc32, nor a tokenizer: the other queries are tested against brute force."""
    return {"op2_quality": _QUALITY_SQL, "op3_suffix_dedup": _SUFFIX_SQL, "op10_chat": _CHAT_SQL, "op11_prefix_trie": _TRIE_SQL, "op13_exact_dedup": _EXACT_SQL}
