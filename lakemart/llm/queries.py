"""One registered query per operator, over its whole table and with production parameters; SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    chat, language, licenses, manifest, mixing, packing, passages, pii, quality, sharding, simhash, vectors, whitening,
)
from lakemart.llm.common import documents, share_code, text_or_empty
from lakemart.session import own_scratch, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own_scratch(spark)
            share_code(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_best_fit_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query("op2_simhash_near_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op3_pii")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(documents(spark, sf_dir))


@query("op4_quality_votes")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


@query("op5_flow_sharding")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the shards that a hash of the source would give, with one hot source, to 16 even ones, rewritten.

    Rows of rewritten shards are read back from the new files: size, text_crc32, shard and slot are what lies there.
    """
    place = ["doc_id", "file_hash", "file_row"]
    docs = documents(spark, sf_dir).select(
        "*", F.xxhash64("_metadata.file_path").alias("file_hash"), F.col("_metadata.row_index").alias("file_row"))
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(12)).cast("int")
    placed = sharding.reshard(docs, old, keys=place)
    path = scratch_path(spark, "new-shards")
    rewritten = sharding.rewrite_affected(docs, placed, path, place)
    files = spark.read.schema(docs.withColumns({"slot": F.lit(0).cast("long"), "shard": F.lit(0)}).schema).parquet(path)
    text = text_or_empty()
    back = files.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), old.alias("old_shard"), "shard", "slot")
    same = placed.where(~F.col("shard").isin(rewritten)).select(back.columns)
    return back.unionByName(same).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard", F.col("shard").isin(rewritten).alias("rewritten"))


@query("op6_nn_descent_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op7_paragraph_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir), shortest=1)


#: conversation -1, whose texts hold another template's control strings.
CONTROL_CASE = """SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),
    (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"""


@query("op8_chat_format", r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
        sum(length(replace(replace(role, '', '\'), '<|', '<\|')) + length(replace(replace(text, '', '\'), '<|', '<\|'))
            + length('<|turn|><|text|><|end|>')) AS formatted_chars
    FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM w""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat.chat_report(chat.format_chat(turns.unionByName(spark.sql(CONTROL_CASE))))


def _level_sql(depth: int) -> str:
    """Budgets of the nodes at one depth of the tree: shares of the parent's by weight, up to their capacity."""
    path, above = f"p{depth}", "''" if depth == 1 else f"p{depth - 1}"
    return f"""
nodes{depth} AS (
    SELECT *, (budget - before) / after AS reach FROM (
        SELECT n.*, b.budget, coalesce(sum(capacity) OVER (PARTITION BY parent ORDER BY capacity / weight, n.path
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
            CAST(sum(weight) OVER (PARTITION BY parent ORDER BY capacity / weight, n.path
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS after
        FROM (SELECT parent, path, tokens, coalesce(w.weight, 1) AS weight, tokens * {MIX_EPOCHS} AS capacity
              FROM (SELECT {above} AS parent, {path} AS path, CAST(sum(n) AS DOUBLE) AS tokens FROM d GROUP BY ALL)
              LEFT JOIN weights w USING (path)) n
        JOIN budget{depth - 1} b ON b.path = n.parent)),
budget{depth} AS (
    SELECT path, tokens, least(capacity, coalesce(max(CASE WHEN capacity > reach * weight THEN reach END)
        OVER (PARTITION BY parent) * weight, capacity)) AS budget FROM nodes{depth}),"""


#: Weights by path; sources share evenly.
MIX_WEIGHTS = {"d0": 5, "d1": 3, "d2": 2} | {
    f"d{k}/{lang}": weight for k in range(3) for lang, weight in (("en", 2), ("de", 1), ("fr", 3), ("es", 4))}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2, 17
MIX_SQL = f"""
WITH weights AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v})" for k, v in MIX_WEIGHTS.items())}) t(path, weight)),
named AS (
    SELECT doc_id, lang, source, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '[0-9]+') AS INT), 0) % 3
        AS VARCHAR) AS domain, (coalesce(strlen(text), 0) + 3) // 4 + 1 AS n FROM documents),
every AS (
    SELECT *, p2 || '/' || coalesce(replace(replace(source, '%', '%25'), '/', '%2F'), '{mixing.NONE}') AS p3 FROM (
        SELECT *, domain || '/' || coalesce(replace(replace(lang, '%', '%25'), '/', '%2F'), '{mixing.NONE}') AS p2,
            domain AS p1 FROM named)),
budget0 AS (SELECT '' AS path, sum(n) * CAST({MIX_SHARE} AS DOUBLE) AS budget FROM every),
d AS (SELECT * FROM every e WHERE NOT EXISTS (
    SELECT 1 FROM weights w WHERE w.weight = 0 AND (w.path = e.p1 OR w.path = e.p2 OR w.path = e.p3))),
{_level_sql(1)}{_level_sql(2)}{_level_sql(3)}
leaves AS (
    SELECT path, CAST(floor(budget / tokens) AS INT) AS epochs, budget - floor(budget / tokens) * tokens AS rest
    FROM budget3),
ordered AS (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY p3 ORDER BY key
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM (SELECT d.*, l.epochs, l.rest, md5('{MIX_SEED}|' || CAST(l.epochs AS VARCHAR) || '|'
              || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM d JOIN leaves l ON l.path = d.p3))
SELECT doc_id, domain, lang, source, n AS tokens,
    CAST(unnest(range(epochs + CASE WHEN ahead < rest THEN 1 ELSE 0 END)) AS INT) AS epoch
FROM ordered"""


def with_domain(docs: DataFrame) -> DataFrame:
    """Three domains by the number in the source's name."""
    number = F.expr("try_cast(regexp_extract(source, '[0-9]+', 0) AS INT)")
    return docs.withColumn("domain", F.concat(F.lit("d"), (F.coalesce(number, F.lit(0)) % 3).cast("string")))


@query("op9_hierarchical_mix", MIX_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(documents(spark, sf_dir)).withColumn("tokens", mixing.token_estimate(F.col("text")))
    mixed = mixing.mix(docs, ["domain", "lang", "source"], MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED,
                       tokens=F.col("tokens"))
    return mixed.select("doc_id", "domain", "lang", "source", "tokens", "epoch")


@query("op10_language_codes")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(documents(spark, sf_dir))


def _licenses_sql() -> str:
    """Every block against every template, by counting the different words that they share."""
    templates = licenses.prepare(licenses.TEMPLATES, licenses.CONTAINMENT)
    words = ", ".join(f"({k}, '{t.label}', '{w}', {t.stride}, {t.least}, {len(t.words)})"
                      for k, t in enumerate(templates) for w in t.words)
    phrases = " ".join("WHEN " + " AND ".join(
        f"{'word' if k == 0 else f'lead(word, {k}) OVER text'} = '{w}'" for k, w in enumerate(phrase.split()))
        + f" THEN '{label}'" for phrase, label in licenses.PHRASES.items())
    return rf"""
WITH t AS (SELECT * FROM (VALUES {words}) t(template, label, word, stride, least, size)),
d AS (
    SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
w AS (SELECT uid, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
base AS (
    SELECT uid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base_labels
    FROM (SELECT uid, pos, CASE {phrases} END AS label FROM w WINDOW text AS (PARTITION BY uid ORDER BY pos))
    WHERE label IS NOT NULL GROUP BY uid),
met AS (
    SELECT uid, label, count(DISTINCT word) / any_value(size) AS containment
    FROM (SELECT uid, t.*, unnest([pos // stride - 1, pos // stride]) AS block FROM w JOIN t USING (word))
    WHERE block >= 0 GROUP BY uid, template, label, block HAVING count(DISTINCT word) >= any_value(least)),
more AS (SELECT uid, list(DISTINCT label) AS labels, max(containment) AS best FROM met GROUP BY uid)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(base_labels, labels))), ','), '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (uid) LEFT JOIN more USING (uid)"""


@query("op11_license_scan", _licenses_sql())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir))


@query("op12_polar_whitening")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text, half a byte at a time with the table of its polynomial."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(str(value))
    half = "xor(({0}) >> 4, [" + ", ".join(table) + "][(({0}) & 15) + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            f"lambda c, b: {half.format(half.format('xor(c, b)'))}), 4294967295)")


#: Levels that the SQL has: 16^5 rows of a source, 16^3 sources.
SQL_LEVELS = {"leaf": 5, "source": 3}


def _manifest_sql() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(map(field, values)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
d AS (
    SELECT doc_id, source, {leaf("text")} AS leaf,
        CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf(lower)} END AS changed FROM documents),
leaf0 AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
        count(*) OVER (PARTITION BY source) AS n FROM (SELECT source, doc_id, leaf AS digest, leaf, changed FROM d)),
proof_leaf0 AS (SELECT source, r, doc_id, leaf, coalesce(changed, leaf) AS folded, '' AS proof FROM leaf0)"""]

    def level(kind: str, group: str, same: str, k: int, number: str) -> str:
        return f"""
around_{kind}{k} AS (
    SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY {group}r // 16 ORDER BY r
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(digest, '') OVER (PARTITION BY {group}r // 16 ORDER BY r
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind FROM {kind}{k}),
proof_{kind}{k + 1} AS (
    SELECT p.* REPLACE (CASE WHEN n > 1 THEN sha256(before || folded || behind) ELSE folded END AS folded,
        CASE WHEN n > 1 THEN proof || before || behind ELSE proof END AS proof)
    FROM proof_{kind}{k} p JOIN around_{kind}{k} a ON {same}a.r = p.{number} // {16 ** k}),
{kind}{k + 1} AS (
    SELECT {group}r // 16 AS r, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY r)) ELSE min(digest) END AS digest,
        (n + 15) // 16 AS n FROM {kind}{k} GROUP BY {group}r // 16, n)"""

    for k in range(SQL_LEVELS["leaf"]):
        parts.append(level("leaf", "source, ", "a.source IS NOT DISTINCT FROM p.source AND ", k, "r"))
    last = SQL_LEVELS["leaf"]
    parts.append(f"""
source0 AS (
    SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM leaf{last}),
proof_source0 AS (
    SELECT p.*, s.r AS s, s.digest AS subroot FROM proof_leaf{last} p
    JOIN source0 s ON s.source IS NOT DISTINCT FROM p.source)""")
    for k in range(SQL_LEVELS["source"]):
        parts.append(level("source", "", "", k, "s"))
    last = SQL_LEVELS["source"]
    return "WITH" + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, (SELECT digest FROM source{last}) AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = (SELECT digest FROM source{last}) AS verified FROM proof_source{last}"""


@query("op13_merkle_descent", _manifest_sql())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest.manifest_report(documents(spark, sf_dir), tampered)
