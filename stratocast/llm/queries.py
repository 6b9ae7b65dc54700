"""The queries of this folder, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat_format,
    decontaminate,
    embedding_dedup,
    fill_in_middle,
    license_scan,
    minhash_dedup,
    source_mixing,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)
from .common import table

#: The rules that op10 is asked for: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: The conversation that op9 adds to the table: (conv_id, turn, role, text).
EXTRA_TURNS = [
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def _sha(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), width=10)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha(F.array_join(names, ",")).alias("items_sha256"),
        "contaminated",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(table(spark, sf_dir, "documents"), *bpe.public_vocabulary())
    return token_counts.suffix_sums(histogram)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), width=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        _sha(F.col("kept")).alias("kept_sha256"),
        (removed > 0).alias("repeated"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = bpe.public_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe.decode(bpe.encode(docs, ranks, pattern).drop("text"), ranks))


def bpe_digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: places looked at, the licenses found (names, joined by
    commas) and the best one's reduction and wording differences."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["reduction"], -x["differences"], x["license"].alias("name"))))
    return found.select(
        "doc_id",
        "n_blocks",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("licenses"),
        best["name"].alias("best_license"),
        best["reduction"].alias("best_reduction"),
        F.array_min(F.transform("licenses", lambda x: x["differences"])).alias("fewest_differences"),
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string"))
    chats = chat_format.format_conversations(turns)
    chats = chats.withColumn("turns", chat_format.read_turns(F.col("formatted")))
    chats = chats.withColumn("loss", chat_format.masked_text(F.col("formatted"), F.col("loss_mask")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha(F.array_join(said, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block list: the canonical URLs of the pages whose id is divisible by 100."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, pages.where("page_id % 100 = 0")).select("page_id", "host", "path", "rule", "verdict")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), wanted=8)
    parts = [] if found is None else [float(x) for x in found.explained]
    explained = F.array(*map(F.lit, parts)).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(0 if found is None else found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(0.0 if found is None else found.identity_error).alias("identity_error"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    moved = fill_in_middle.fill_in_middle(docs, seed=7, rate=100, spm=50).drop("text")
    return fill_in_middle.restore(moved).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", _sha(F.col("output")).alias("output_sha256"), _sha(F.col("restored")).alias("restored_sha256")
    )


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = source_mixing.mix(docs, F.array("source"), weights=(1, 2, 3), most=3, share=1.0, seed=7)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_QUERIES = (
    op1_decontamination,
    op2_token_counts,
    op3_suffix_dedup,
    op4_byte_bpe,
    op5_license_scan,
    op6_embedding_near_dedup,
    op7_toxicity,
    op8_minhash_near_dedup,
    op9_chat_format,
    op10_url_filter,
    op11_embedding_whitening,
    op12_fill_in_middle,
    op13_source_mixing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
placed AS (
  SELECT *, regexp_replace(text, '<(\\*)(turn>|sep>|/turn>)', '<\\\1\2', 'g') AS safe,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(safe) + CASE WHEN before = role THEN 5
         ELSE 15 + length(role) + (length(role) - length(replace(replace(role, '\', ''), chr(10), ''))) END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""

_URL_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         coalesce(regexp_extract(url, '^[^?#]*\?([^#]*)', 1, 's'), '') AS query FROM pages),
named AS (
  SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN
      regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') ||
      coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') END AS name
  FROM parts),
listed AS (SELECT DISTINCT name FROM named WHERE page_id % 100 = 0 AND name IS NOT NULL),
ruled AS (
  SELECT n.*, l.name IS NOT NULL AS hit,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named n LEFT JOIN listed l ON n.name = l.name)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN hit THEN 'block' ELSE 'allow' END AS verdict FROM ruled"""

_MIDDLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
lined AS (
  SELECT *, length(text) - length(replace(text, chr(10), '')) + CAST(text <> '' AND NOT ends_with(text, chr(10)) AS BIGINT) AS n,
         [CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS d FROM texts),
cut AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 100 THEN 'plain'
              WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, string_split(text, chr(10)) AS lines FROM lined),
parts AS (
  SELECT *, CASE WHEN a = n THEN text ELSE coalesce(list_aggregate([x || chr(10) FOR x IN lines[1 : a]], 'string_agg', ''), '') END AS p,
         CASE WHEN b = n THEN text ELSE coalesce(list_aggregate([x || chr(10) FOR x IN lines[1 : b]], 'string_agg', ''), '') END AS pm FROM cut),
split AS (SELECT *, substr(pm, length(p) + 1) AS m, substr(text, length(pm) + 1) AS s FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(p || m || s) AS restored_sha256
FROM split"""


def oracle_sql() -> dict[str, str]:
    return {"op9_chat_format": _CHAT_SQL, "op10_url_filter": _URL_SQL, "op12_fill_in_middle": _MIDDLE_SQL}
