"""The operators over the given tables, with production parameters, and comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from sluice.llm import (byte_bpe, embeddings, exact_dedup, html_text, licences, line_dedup, merkle, mixing, ngram_join, prefix_trie,
                        surrogates, toxicity, url_filters)
from sluice.llm.scratch import Scratch
from sluice.llm.texts import ascii_lower

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("times")


@query("op2_surrogates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(documents(spark, sf_dir), key="production-key")


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(documents(spark, sf_dir), TOKENIZER, public_tokenizers.PATTERN)


@query("op4_line_dedup", """WITH line AS (
  SELECT doc_id, i - 1 AS no, regexp_extract_all(x[i], '[^ \\t-\\r]+') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents) t, unnest(range(1, len(x) + 1)) r(i)),
known AS (SELECT array_to_string(words, ' ') AS k, min((doc_id, no)) AS place, any_value(words) AS words, any_value(len(words)) AS n
  FROM line WHERE len(words) > 0 GROUP BY 1),
variant AS (SELECT k, place, n, i, array_to_string(words[1 : i - 1] || words[i + 1 : n], ' ') AS v
  FROM known, unnest(range(1, n + 1)) r(i) WHERE n >= 10),
near AS (
  SELECT k FROM (SELECT k, place, min(place) OVER (PARTITION BY n, i, v) AS lead FROM variant) WHERE lead < place
  UNION SELECT t.k FROM variant t JOIN known s ON t.v = s.k WHERE t.n > 10 AND s.place < t.place
  UNION SELECT s.k FROM variant t JOIN known s ON t.v = s.k WHERE t.n > 10 AND t.place < s.place),
fate AS (SELECT l.doc_id, l.no, len(l.words) = 0 OR (k.place = (l.doc_id, l.no) AND near.k IS NULL) AS kept
  FROM line l LEFT JOIN known k ON k.k = array_to_string(l.words, ' ') LEFT JOIN near ON near.k = k.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (kept) AS n_kept,
  coalesce(string_agg(no::VARCHAR, ',' ORDER BY no) FILTER (NOT kept), '') AS dropped FROM fate GROUP BY doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(documents(spark, sf_dir))


@query("op5_embedding_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op7_ngram_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.learn(docs, labels, ~held_out)
    return toxicity.scored(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "rejected")


def _licence_sql() -> str:
    """Every place of every key phrase, without the index."""
    def strings(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    columns, covered = [], []
    for t in licences.TEMPLATES:
        key, notice = t.key.split(), t.notice.split()
        name = t.name
        columns.append(f"CASE WHEN contains(joined, ' {t.key} ') THEN list_filter(range(0, len(words) - {len(key) - 1}), lambda p: words[p + 1 : p + {len(key)}] = {strings(key)}) ELSE []::BIGINT[] END AS {name}")
        shares = " + ".join(f"CASE WHEN p + {j - t.at} >= 0 AND words[p + {j - t.at + 1}] = '{w}' THEN 1 ELSE 0 END" for j, w in enumerate(notice))
        covered.append(f"list_max(list_transform({name}, lambda p: ({shares}) / {len(notice)}.0::DOUBLE))")

    def labels(which) -> str:
        return "array_to_string(list_filter([" + ", ".join(
            f"CASE WHEN {' OR '.join(f'len({t.name}) > 0' for t in which if t.label == label)} THEN '{label}' END"
            for label in sorted({t.label for t in which})) + "], lambda x: x IS NOT NULL), ',')"

    base = [t for t in licences.TEMPLATES if t.base]
    joined = " || ".join(t.name for t in base)
    return f"""WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
j AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM w),
found AS (SELECT doc_id, words, {', '.join(columns)} FROM j)
SELECT doc_id, len(words)::BIGINT AS n_words, len({joined})::BIGINT AS n_base,
  list_min({joined})::BIGINT AS first_word, list_max({joined})::BIGINT AS last_word,
  {labels(base)} AS base_labels, {labels(licences.TEMPLATES)} AS labels,
  coalesce(greatest({', '.join(covered)}), 0.0)::DOUBLE AS score FROM found"""


@query("op9_licence_scan", _licence_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("places")


@query("op10_exact_dedup", f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
WINDOW same AS (PARTITION BY t)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf_dir), exact_dedup.new_index(spark), batches=2)


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit."""
    step = "list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT), lambda a, b: {step}), 4294967295)"


@query("op11_prefix_trie", f"""WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS side, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS d, length(text) AS points,
    string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (w ROWS UNBOUNDED PRECEDING) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY side, pos)
  UNION ALL SELECT conv_id, 0, 0, '', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c),
node AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256 FROM p GROUP BY d, k),
-- A node's least member passes all nodes above it.
above AS (SELECT u.d AS d, u.k AS k, v.d AS vd, v.k AS vk FROM node u JOIN p v ON v.conv_id = u.conv_id AND v.d <= u.d),
leaf AS (SELECT d, k, NOT EXISTS (SELECT 1 FROM above a WHERE a.vd = node.d AND a.vk = node.k AND a.d = node.d + 1) AS childless FROM node),
total AS (SELECT vd AS d, vk AS k, count(*) FILTER (d = vd + 1) AS n_children, count(*) FILTER (childless) AS n_leaves,
  sum((n_convs - 1) * points) AS saved_tokens FROM above JOIN leaf USING (d, k) JOIN node USING (d, k) GROUP BY vd, vk),
parent AS (SELECT a.d, a.k, v.conv_id AS parent_conv_id FROM above a JOIN node v ON v.d = a.vd AND v.k = a.vk WHERE a.vd = a.d - 1)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM node JOIN total USING (d, k) LEFT JOIN parent USING (d, k)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(*prefix_trie.grafted(conversations, Scratch(spark, "grafted")))


def _merkle_sql() -> str:
    """Level by level, up to 8 ** 10 leaves in a part and 8 ** 10 parts."""
    def h(*fields: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"

    levels = 10
    lines = [f"""t AS (SELECT *, CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS other FROM documents)""",
             f"l AS (SELECT *, {h('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf, {h('doc_id', 'source', 'lang', 'n_chars', 'other')} AS changed FROM t)",
             "r AS (SELECT doc_id, lang, leaf, changed, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l)",
             "a0 AS (SELECT lang, i, leaf AS d FROM r)"]

    def raised(name: str, k: int, key: str) -> None:
        lines.append(f"{name}k{k} AS MATERIALIZED (SELECT {key}, i // 8 AS i, list(d ORDER BY i) AS kids, any_value(m) AS m FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS m FROM {name}{k}) GROUP BY {key}, i // 8)")
        lines.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {key}, i, CASE WHEN m = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS d FROM {name}k{k})")

    for k in range(levels):
        raised("a", k, "lang")
    lines.append(f"b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, d, lang FROM a{levels})")
    for k in range(levels):
        raised("b", k, "one")
    lines.append(f"""w0 AS (SELECT r.doc_id, r.lang, r.leaf, r.i, b0.i AS j, b0.d AS subroot, b{levels}.d AS root, '' AS proof, r.changed AS folded
      FROM r JOIN b0 ON b0.lang IS NOT DISTINCT FROM r.lang, b{levels})""")
    at = 0
    for name, place, key in (("a", "i", "p.lang IS NOT DISTINCT FROM w.lang"), ("b", "j", "true")):
        for k in range(levels):
            before, after = f"array_to_string(kids[1 : w.{place} % 8], '')", f"array_to_string(kids[w.{place} % 8 + 2 :], '')"
            lines.append(f"""w{at + 1} AS (SELECT w.* REPLACE (w.{place} // 8 AS {place}, CASE WHEN m = 1 THEN proof ELSE proof || {before} || {after} END AS proof,
              CASE WHEN m = 1 THEN folded ELSE sha256({before} || folded || {after}) END AS folded)
              FROM w{at} w JOIN {name}k{k} p ON {key} AND p.i = w.{place} // 8)""")
            at += 1
    return "WITH " + ",\n".join(lines) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM w{at}"""


@query("op12_merkle_manifest", _merkle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.verified(documents(spark, sf_dir), changed={"text": tampered}).withColumnRenamed("key", "doc_id")


def _url_sql() -> str:
    rules = " ".join(f"WHEN fit('{p}', host, path) THEN '{p}'" for p, _ in sorted(url_filters.PREFIXES, key=lambda r: -len(r[0])))
    verdicts = " ".join(f"WHEN '{p}' THEN '{v}'" for p, v in url_filters.PREFIXES)
    for p, _ in url_filters.PREFIXES:
        host, path = p.split("/", 1)
        rules = rules.replace(f"fit('{p}', host, path)", f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')")

    def first(verdict: str) -> str:
        found = sorted((p for p, v in url_filters.PATTERNS if v == verdict), key=lambda p: (-len(p), [-ord(c) for c in p]))
        return " ".join(f"WHEN regexp_matches(low, '{url_filters.rule_regex(p)}') THEN '{p}'" for p in found)

    return f"""WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
s AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
  translate(rest, '{UPPER}', '{LOWER}') AS low FROM h),
j AS (SELECT *, CASE {rules} END AS rule, CASE {first('allow')} END AS allowing, CASE {first('block')} END AS blocking FROM s)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN allowing IS NULL AND blocking IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict,
  CASE WHEN rule IS NULL THEN coalesce(allowing, blocking) END AS pattern FROM j"""


@query("op13_url_filters", _url_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("n_candidates")
