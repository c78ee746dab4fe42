"""Registered queries over the supplied tables and their SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm.byte_bpe import encode_and_decode
from punctua.llm.conversation_trie import ordered_turns, rebuilt, trie_of
from punctua.llm.decontaminate import contamination
from punctua.llm.exact_dedup import exact_duplicates
from punctua.llm.line_dedup import drop_site_lines, html_lines
from punctua.llm.near_dedup import near_groups
from punctua.llm.periodic_runs import periodic_runs, planted, strongest
from punctua.llm.quality import held_out, quality_scores
from punctua.llm.rows import new_folder, written
from punctua.llm.secrets import BASE_RULES, scan_secrets
from punctua.llm.sharding import shuffle_into_shards
from punctua.llm.token_files import read_token_files, write_token_files
from punctua.llm.toxicity import toxicity_scores
from punctua.llm.url_filter import LOWER, UPPER, host_and_path, judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans(findings):
    texts = F.transform(
        findings,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, new_folder(docs, "secret-ledger")).select("doc_id", "findings")
    base_kinds = [r.name for r in BASE_RULES]
    base = F.filter("findings", lambda s: s["kind"].isin(base_kinds))

    def count(kind):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in base_kinds]
    return found.select(
        "doc_id", *counts,
        F.sha2(_spans(base), 256).alias("base_sha256"), _spans(F.col("findings")).alias("spans"),
    )


# Fixed values of the contract.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.sql(
        "SELECT * FROM VALUES "
        + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
        + " AS rules(host, path, verdict)"
    )
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = f"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES {", ".join(str(r) for r in URL_RULES)}
), fits AS (
    SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
        row_number() OVER (
            PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC
        ) AS place
    FROM split JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT s.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND place = 1
"""


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_groups(docs, width=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = toxicity_scores(docs, labels, keep_out=held_out, language="lang")
    rest = [c for c in scores.columns if c != "id"]
    return scores.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), *rest)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    body = F.coalesce("text", F.lit(""))
    return shuffle_into_shards(docs, 40, seed=5).select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), cuts AS (
    SELECT item_id, least(len(words), 10) AS size, words,
        unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos
    FROM items WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS body FROM cuts
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
    FROM docs, sizes WHERE len(words) >= size
), found AS (
    SELECT doc_id, item_id, pos, p.size FROM (
        SELECT doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') AS body FROM places
    ) p JOIN windows w ON p.body = w.body AND p.size = w.size
), hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_and_decode(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
    )
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    found = exact_duplicates(docs.withColumn("text_sha256", digest), carry=["doc_id", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), threshold=0.7)
    return scores.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, _ = host_and_path(F.col("url"))
    texts = pages.select("page_id", host.alias("host"), html_lines(F.col("html")).alias("text"))
    return drop_site_lines(texts).select(
        "page_id", "host", "host_pages", "n_lines", "n_dropped",
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs, keep=["doc_id"]).withColumn("best", strongest(F.col("runs")))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, one bit after the other."""
    bits = (
        f"flatten(list_transform(string_split({text}, ''), "
        "lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))"
    )
    step = "lambda acc, bit: xor(acc >> 1, 3988292384 * (xor(acc, bit) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), {step}), 4294967295)"


OP11_SQL = f"""
WITH docs AS (
    SELECT doc_id, h, h // 10 AS g, words, CAST(len(words) AS BIGINT) AS n FROM (
        SELECT doc_id, {_crc32_sql("CAST(doc_id AS VARCHAR)")} AS h,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    )
), starts AS (
    SELECT doc_id, words, n, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a, g FROM docs
), periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM starts
), places AS (
    SELECT doc_id, n, i, words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM periods)
), equal AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i FROM places x
    JOIN places y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), best AS (
    SELECT *, row_number() OVER (
        PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period
    ) AS rank FROM runs
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body
    FROM places p ANTI JOIN dropped d ON p.doc_id = d.doc_id AND p.i = d.i GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
    1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(body, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
    LEFT JOIN best b ON d.doc_id = b.doc_id AND rank = 1
"""


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = f"{new_folder(docs, 'token-set')}/set"
    write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), target, end_id=1)
    return read_token_files(spark, target).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    turns = written(ordered_turns(talks), new_folder(talks, "turns"), "turns")
    return trie_of(*rebuilt(turns)).drop("node")


OP13_SQL = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))
        ) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS taken
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON c.conv_id = t.conv_id AND place > taken
    UNION ALL
    SELECT c.conv_id, place, role, text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= taken
), paths AS (
    SELECT c.conv_id, coalesce(path, []) AS path FROM convs c LEFT JOIN (
        SELECT conv_id, list(strlen(role) || ':' || role || text ORDER BY place) AS path
        FROM rebuilt GROUP BY conv_id
    ) r ON c.conv_id = r.conv_id
), steps AS (
    SELECT conv_id, path[1:depth] AS node, depth, len(path) AS size
    FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths)
), lengths AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, length(text) AS chars
    FROM rebuilt
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = depth AS childless,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth) AS ends
    FROM steps GROUP BY node, depth
), valued AS (
    SELECT n.*, (n_convs - 1) * coalesce(chars, 0) AS saved
    FROM nodes n LEFT JOIN lengths l ON n.conv_id = l.conv_id AND n.depth = l.depth
), family AS (
    SELECT path[1:up] AS node, up AS depth, v.depth AS below, childless, saved FROM (
        SELECT *, node AS path, unnest(range(0, depth + 1)) AS up FROM valued
    ) v
), sums AS (
    SELECT node, depth, count(*) FILTER (WHERE below = depth + 1) AS n_children,
        count(*) FILTER (WHERE childless) AS n_leaves, sum(saved) AS saved_tokens
    FROM family GROUP BY node, depth
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, s.n_children,
    s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN sums s ON v.node = s.node AND v.depth = s.depth
    LEFT JOIN valued p ON p.depth = v.depth - 1 AND p.node = v.node[1 : v.depth - 1]
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_url_filter, op3_minhash_near_dedup, op4_toxicity, op5_sharding,
        op6_decontamination, op7_byte_bpe, op8_exact_dedup, op9_quality, op10_line_dedup,
        op11_periodic_runs, op12_token_files, op13_conversation_trie,
    )
}
SQL = {
    "op2_url_filter": OP2_SQL,
    "op6_decontamination": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op13_conversation_trie": OP13_SQL,
}
