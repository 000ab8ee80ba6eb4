"""The registered queries of these operators, over whole tables, and their oracles where SQL can express them."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import (
    conversation_repair, decontamination, hard_negatives, jaccard_join, mixing, quality_gam, quality_rules, sharding, span_dedup, token_counts, tool_calls, toxicity, url_filters,
)
from recordloom.llm.tables import table, written

SHARDS = 24


@functools.lru_cache(maxsize=1)
def _package() -> str:
    """This package as a zip file, for executors that do not have it on their path."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(), "recordloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "recordloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    return path


def shipped[**P](query: Callable[P, DataFrame]) -> Callable[P, DataFrame]:
    """The query, whose first argument is the session, with this package sent to the executors first."""

    @functools.wraps(query)
    def run(*args: P.args, **options: P.kwargs) -> DataFrame:
        args[0].sparkContext.addPyFile(_package())  # type: ignore[attr-defined]
        return query(*args, **options)

    return run


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only this query needs it; the vocabulary file is never copied

    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").withColumn("low_quality", 1 - F.col("quality"))
    return toxicity.predict(docs, toxicity.train(docs, labels, ["low_quality", "toxic"]), flag="toxic")


def additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_gam.score(docs, quality_gam.train(docs, table(spark, folder, "labels")))


def benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def splitter_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    slim = docs.select(
        "doc_id",
        sharding.size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        sharding.text_key(F.col("text"), F.col("doc_id")).alias("key"),
    )
    placed = sharding.assign(written(slim, "shard-keys"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The tools that the conversations' turns are read as calls of.
TOOL_SCHEMAS = {
    "answer": {
        "type": "object", "required": ["question", "words"], "additionalProperties": False,
        "properties": {"question": {"type": "string", "minLength": 1, "maxLength": 400}, "words": {"type": "integer", "minimum": 1, "maximum": 60}, "after": {"type": "object"}},
    },
    "summarise": {
        "type": "object", "required": ["question"], "additionalProperties": False,
        "properties": {"question": {"type": "string", "minLength": 30}, "words": {"type": "integer"}, "after": {"type": "object"}},
    },
}


def tool_call_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Each user turn read as a tool call that refers to the one half as far into the conversation, each assistant turn as the result of the call before it."""
    turns = table(spark, folder, "conversations")
    identifier = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    half = F.floor(F.col("turn") / 2)
    arguments = F.to_json(F.struct(
        F.when(F.col("turn") > 1, F.struct(identifier(half).alias("$ref"))).alias("after"),
        F.size(F.split(F.coalesce("text", F.lit("")), " ")).alias("words"), F.coalesce("text", F.lit("")).alias("question"),
    ))
    calls = turns.where("role = 'user'").select("conv_id", "turn", identifier(F.col("turn")).alias("call_id"), F.when(F.col("turn") % 3 == 0, "answer").otherwise("summarise").alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", identifier(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    others = turns.where("role NOT IN ('user', 'assistant') OR role IS NULL").select("conv_id", "turn", "role", F.col("text").alias("content"))
    return tool_calls.link(calls, results, TOOL_SCHEMAS, others)


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("pieces")


def jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked_documents(table(spark, folder, "documents"), words_per_gram=4, percent=85)


def quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    base = quality_rules.mask(quality_rules.POLICIES[1])
    return quality_rules.ledger(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(base).cast("bigint")) != 0).alias("base_failed"),
        quality_rules.passes(2).alias("kept"),
        "failed",
    )


def earlier_span_removal(spark: SparkSession, folder: str) -> DataFrame:
    return span_dedup.without_repeats(table(spark, folder, "documents"), length=100, with_text=False)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults by crc32 of ``conv_id:turn``: dropped, emptied, without sentence ends, repeated, or given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    changed = changed.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))).drop("col")


def repaired_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its faults, its cheapest repair, and the hash of the repaired turns."""
    turns = table(spark, folder, "conversations")
    summary, messages = conversation_repair.repair(damaged(turns))
    hashes = conversation_repair.digests(messages).withColumnRenamed("conv_id", "hashed")
    found = summary.join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left").drop("hashed").withColumnRenamed("conv_id", "found")
    every = turns.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


#: Hosts, with beginnings of paths, that are judged as a whole.
PLACES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Words that mark a host or path as unwanted, and what is let through all the same.
GLOBS = [*(("block", f"^{word}^") for word in ("adult", "ads", "bets", "casino", "pills", "porn", "spam")), ("allow", "||gov/"), ("allow", "||edu/")]


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_filters.rule_table(spark, [("place", p, v) for v, p in PLACES] + [("glob", p, v) for v, p in GLOBS])
    return url_filters.judge(table(spark, folder, "pages"), rules).drop("pattern")


def hard_negatives_mined(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives for every hundredth vector, where a seventh of the labels is wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("own") + 1) % 10).otherwise(F.col("own"))
    return hard_negatives.mine(hard_negatives.usable_rows(table(spark, folder, "embeddings"), label=label), F.col("vec_id") % 100 == 0)


_LEDGER_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), by_lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
    len(list_filter(range(2, len(ws) + 1), lambda k: ws[k] = ws[k - 1])) AS n_echoes
  FROM w LEFT JOIN by_lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), bits AS (
  SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT)
    + 4 * CAST(100 * n_symbols > 3 * word_chars AS BIGINT) + 8 * CAST(100 * n_dup_lines > 40 * n_lines AS BIGINT)
    + 16 * CAST(100 * n_upper > 40 * n_letters AS BIGINT)
    + 32 * CAST(word_chars > 30 * n_words OR word_chars < 2 * n_words AS BIGINT)
    + 64 * CAST(100 * n_echoes > 30 * n_words AS BIGINT) AS failed
  FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  failed % 4 <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM bits
"""


def _repair_sql() -> str:
    """Cheapest edits by a fold over a conversation's turns that keeps the best (cost, audit) of each state as text: twelve digits, then the audit."""
    add = lambda x, cost, letter: f"(lpad(CAST(CAST(left({x}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({x}, 13) || '{letter}')"
    keep = lambda x, initial: f"CASE WHEN r[1] = '{initial}' AND r[2] = '0' THEN {add(x, 'CAST(r[3] AS BIGINT)', 'K')} END"
    rename = lambda x: f"CASE WHEN r[2] = '0' THEN {add(x, '2 + CAST(r[3] AS BIGINT)', 'R')} END"
    least = lambda *xs: f"least({', '.join(xs)})"
    bare = [
        add("acc[1]", 3, "D"),
        least(add("acc[2]", 3, "D"), keep("acc[1]", "s")),
        least(add("acc[3]", 3, "D"), *[keep(f"acc[{k}]", "u") for k in (1, 2, 4)], *[rename(f"acc[{k}]") for k in (1, 2, 4)]),
        least(add("acc[4]", 3, "D"), keep("acc[3]", "a"), rename("acc[3]")),
    ]
    return rf"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t
), texts AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), hashed AS (
  SELECT texts.*, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda j: CAST(ascii(k[j]) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM texts, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged
), faulty AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS known,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS late, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND known) AS duplicate,
    count(*) FILTER (NOT blank AND NOT known AND late) AS truncated, count(*) FILTER (i > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
    list([left(role, 1), CASE WHEN blank OR known THEN '1' ELSE '0' END, CASE WHEN late THEN '1' ELSE '0' END] ORDER BY i) AS turns
  FROM faulty GROUP BY conv_id
), folded AS (
  SELECT *, list_reduce(turns, lambda acc, r: list_transform([[{', '.join(bare)}]], lambda b: list_transform([least(b[3], {add('b[1]', 2, 'I')}, {add('b[2]', 2, 'I')}, {add('b[4]', 2, 'I')})],
    lambda u: [b[1], b[2], u, least(b[4], {add('u', 2, 'I')})])[1])[1],
    ['000000000000', NULL, '000000000002I', '000000000004II']) AS ends FROM counted
), best AS (
  SELECT *, CAST(left(least(ends[1], ends[4]), 12) AS BIGINT) AS cost, substr(least(ends[1], ends[4]), 13) AS audit FROM folded
), letters AS (
  SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, audit FROM best
), marked AS (
  SELECT conv_id, k, audit[k] AS letter, sum(CASE WHEN audit[k] <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN audit[k] <> 'D' THEN 1 ELSE 0 END) OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), kept AS (
  SELECT m.*, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, max(CASE WHEN o = 1 AND letter = 'K' AND f.role LIKE 's%' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS system
  FROM marked m LEFT JOIN faulty f ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.i = f.i AND letter <> 'I' WHERE letter <> 'D'
), joined AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS h FROM kept GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN best b ON e.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN joined j ON e.conv_id IS NOT DISTINCT FROM j.conv_id
"""


_URLS_SQL = rf"""
WITH rules (verdict, rule) AS (
  VALUES {', '.join(f"('{v}', '{p}')" for v, p in PLACES)}
), p AS (
  SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), fitting AS (
  SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN rules
    ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
  WHEN regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[^/?#]*://([^/?#]*\.)?(gov|edu)/') THEN 'allow'
  WHEN regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9%]({'|'.join(g[1:-1] for v, g in GLOBS if v == 'block')})([^a-z0-9%]|$)') THEN 'block'
  ELSE 'allow' END) AS verdict FROM p LEFT JOIN fitting USING (k)
"""

_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same, CAST(list_dot_product(a.c, r.c) AS BIGINT) AS score FROM v a, v r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_chain": toxicity_chain,
    "op2_benchmark_passages": benchmark_passages,
    "op3_token_counts": token_count,
    "op4_splitter_shards": splitter_shards,
    "op5_tool_call_messages": tool_call_messages,
    "op6_source_mix": source_mix,
    "op7_jaccard_components": jaccard_components,
    "op8_quality_ledger": quality_ledger,
    "op9_earlier_spans": earlier_span_removal,
    "op10_additive_quality": additive_quality,
    "op11_repaired_conversations": repaired_conversations,
    "op12_url_verdicts": url_verdicts,
    "op13_hard_negatives": hard_negatives_mined,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}

ORACLES: dict[str, str] = {
    "op8_quality_ledger": _LEDGER_SQL,
    "op11_repaired_conversations": _repair_sql(),
    "op12_url_verdicts": _URLS_SQL,
    "op13_hard_negatives": _NEGATIVES_SQL,
}
