"""Personal data in whole texts: patterns, redaction, gate, term scrubbing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalogue import query
from sluice.catalogue.views import table, view
from sluice.functions.pii import is_staff_key_col, redact, value_pattern
from sluice.operators.pii import (TermTable, pattern_hits, scrub_term_table, scrub_terms, staff_terms, term_patterns,
                                  terms_left, with_terms_left)
from sluice.session import bounded_rows, cut_lineage


def hit_sql(column: str) -> str:
    """First matching pattern; the comparison engine has no lookaround, so the
    two id shapes are written with consumed boundaries and with token tests."""
    t = f"trim({column}, E' \\t\\r\\n')"
    return rf"""CASE WHEN regexp_matches({t}, '^\+?(263[0-9]{{9}}|265[0-9]{{7,9}})$') THEN 'phone_international'
  WHEN regexp_matches({t}, '^0[67][0-9]{{8}}$') THEN 'phone_local_zw' WHEN regexp_matches({t}, '^0[89][0-9]{{8}}$') THEN 'phone_local_mwi'
  WHEN regexp_matches({t}, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}') THEN 'email'
  WHEN regexp_matches({t}, '^[0-9]{{3}}[- ][0-9]{{3}}[- ][0-9]{{4}}$') THEN 'nhs_number'
  WHEN regexp_matches({t}, '(^|[^A-Za-z0-9])[0-9]{{2}}[- ]{{0,2}}[0-9]{{6,7}}[- ]{{0,2}}[A-Za-z][- ]{{0,2}}[0-9]{{2}}($|[^A-Za-z0-9])') THEN 'zw_national_id'
  WHEN len([w for w in regexp_extract_all({t}, '[A-Za-z0-9-]+') if regexp_matches(w, '^[A-Za-z0-9]{{8}}$')
    AND len(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 2 AND len(regexp_replace(w, '[^0-9]', '', 'g')) >= 2]) > 0 THEN 'mw_national_id' END"""


@query("pii_redact_text", f"""SELECT doc_id AS id, 'documents' AS source, {hit_sql('text')} AS pattern FROM documents
 UNION ALL SELECT conv_id * 1000 + turn, 'conversations', {hit_sql('text')} FROM conversations""")
def pii_redact_text(spark, sf_dir):
    """Pattern that removes each text (null: the text stays)."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.lit("documents").alias("source"), value_pattern(F.col("text")).alias("pattern"))
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("conversations").alias("source"),
        value_pattern(F.col("text")).alias("pattern"))
    return docs.unionByName(turns)


@query("pii_redact_cells", f"""SELECT _rid, CASE WHEN {hit_sql('note_value')} IS NULL THEN note_value END AS note_value,
 {hit_sql('note_value')} AS pattern FROM dirty_orders""", ("dirty_orders",))
def pii_redact_cells(spark, sf_dir):
    return view(spark, sf_dir, "dirty_orders").select(
        "_rid", redact(F.col("note_value")).alias("note_value"), value_pattern(F.col("note_value")).alias("pattern"))


@query("pii_audit", f"""SELECT 'pii' AS step, 'note_value' AS "column", {hit_sql('note_value')} AS metric, count(*) AS n
 FROM dirty_orders WHERE {hit_sql('note_value')} IS NOT NULL GROUP BY 3
 UNION ALL SELECT 'pii', 'price_value', {hit_sql('price_value')}, count(*) FROM dirty_orders
 WHERE {hit_sql('price_value')} IS NOT NULL GROUP BY 3
 UNION ALL SELECT 'pii', 'uniquekey', {hit_sql('uniquekey')}, count(*) FROM dirty_orders
 WHERE {hit_sql('uniquekey')} IS NOT NULL GROUP BY 3""", ("dirty_orders",))
def pii_audit(spark, sf_dir):
    return pattern_hits(view(spark, sf_dir, "dirty_orders"), ["note_value", "price_value", "uniquekey"])


@query("pii_gate", f"""WITH r AS (SELECT CASE WHEN {hit_sql('text')} IS NULL THEN text END AS text FROM documents)
SELECT count(*) AS n_texts, count(text) AS n_kept, count({hit_sql('text')}) AS n_hits_left FROM r""")
def pii_gate(spark, sf_dir):
    """Texts kept by redaction and pattern matches left in them (none)."""
    safe = table(spark, sf_dir, "documents").select(redact(F.col("text")).alias("text"))
    return safe.agg(F.count(F.lit(1)).alias("n_texts"), F.count("text").alias("n_kept"),
                    F.count(value_pattern(F.col("text"))).alias("n_hits_left"))


_SINGLE = ("there", "ist", "que", "Les")
_MULTI = ("und der", "de la", "it is")


def _terms_sql(column: str) -> str:
    """Whole-word replacement with consumed boundaries, applied twice because
    neighbouring matches share a boundary character."""
    out = column
    multi = "|".join(sorted(_MULTI, key=lambda t: (-len(t), t)))
    single = "|".join(sorted(_SINGLE, key=lambda t: (-len(t), t)))
    for flag, words in (("(?i)", multi), ("", single)):
        for _ in range(2):
            out = rf"regexp_replace({out}, '{flag}(^|[^A-Za-z0-9_])({words})($|[^A-Za-z0-9_])', '\1[staff]\3', 'g')"
    return out


@query("scrub_terms", f"""SELECT doc_id, md5(s) AS text_md5, len(s) AS n_chars, false AS left_over
 FROM (SELECT doc_id, {_terms_sql('text')} AS s FROM documents) d""")
def scrub_terms_query(spark, sf_dir):
    """Listed terms replaced in whole texts, and the residual check."""
    patterns = term_patterns([*_SINGLE, *_MULTI])
    df = table(spark, sf_dir, "documents").select("doc_id", scrub_terms(F.col("text"), patterns).alias("s"))
    return df.select("doc_id", F.md5("s").alias("text_md5"), F.length("s").cast("bigint").alias("n_chars"),
                     terms_left(F.col("s"), patterns).alias("left_over"))


_OPENINGS = """SELECT DISTINCT t AS term FROM (SELECT unnest([w[1], array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' ')]) AS t
  FROM (SELECT regexp_extract_all(text, '[A-Za-z0-9_]+') AS w FROM conversations) a) b WHERE length(t) > 3"""


def _term_table_sql() -> str:
    """Words stand between marks, so that a term's ends are seen without being consumed; each text is searched for the
    terms it holds as a string."""
    def marked(x: str) -> str:
        return f"regexp_replace({x}, '([A-Za-z0-9_]+)', chr(1) || '\\1' || chr(1), 'g')"

    def pattern(flag: str, blank: str) -> str:
        return f"'{flag}(' || string_agg(m, '|' ORDER BY length(term) DESC, term) FILTER (WHERE {blank}contains(term, ' ')) || ')'"

    return f"""WITH t AS (SELECT term, {marked('term')} AS m FROM ({_OPENINGS}) o),
 p AS (SELECT doc_id, {pattern('(?i)', '')} AS several, {pattern('', 'NOT ')} AS single
  FROM documents JOIN t ON contains(lower(text), lower(term)) GROUP BY doc_id),
 a AS (SELECT d.doc_id, {marked('text')} AS s, several, single FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id),
 b AS (SELECT doc_id, CASE WHEN several IS NULL THEN s ELSE regexp_replace(s, several, '[staff]', 'g') END AS s, single FROM a),
 e AS (SELECT doc_id, replace(CASE WHEN single IS NULL THEN s ELSE regexp_replace(s, single, '[staff]', 'g') END, chr(1), '') AS s FROM b)
 SELECT doc_id, md5(s) AS text_md5, len(s) AS n_chars, false AS left_over FROM e"""


@query("scrub_term_table", _term_table_sql())
def scrub_term_table_query(spark, sf_dir):
    """A term table that grows with the input (first one, two and three words of every turn) removed from whole texts,
    and the residual check."""
    words = F.regexp_extract_all(F.col("text"), F.lit("[A-Za-z0-9_]+"), F.lit(0))
    terms = (table(spark, sf_dir, "conversations").select(words.alias("w"))
             .select(F.explode(F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda n: F.array_join(F.slice("w", 1, n), " "))).alias("term"))
             .filter(F.length("term") > 3).distinct())
    terms = TermTable(terms)
    clean = scrub_term_table(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", terms)
    if terms.far_sizes:  # the residual check reads the texts twice
        clean = cut_lineage(clean)
    return (with_terms_left(clean, "text", terms, "left_over")
            .select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"), "left_over"))


_KEY = "CASE WHEN p_size % 5 = 0 THEN 'hcw_id.value' WHEN p_size % 5 = 1 THEN 'DRID' ELSE 'wardname' END"
_TEXT = ("CASE WHEN p_size % 5 < 2 THEN CASE WHEN p_size % 3 = 0 THEN p_type WHEN p_size % 3 = 1 THEN concat(p_name, ' ', p_brand) "
         "ELSE concat('Roe', cast(p_partkey AS string)) END ELSE concat(p_type, ' for ', p_name) END")


@query("staff_terms", rf"""WITH o AS (SELECT {_KEY} AS k, {_TEXT} AS t FROM part),
 f AS (SELECT regexp_matches(replace(regexp_replace(k, '(\.value|\.label)$', ''), '_', ''),
  '(?i)^(hcwsig|hcwsigdis|signature|eqhcwsig|dataentryname|dataentrynameother|otherclinicians|eqdqc|concall|firm|delhcwname|hcwname|hcwid|hcwiddis|drid|reviewid)$') AS staff, trim(t) AS t FROM o),
 w AS (SELECT DISTINCT unnest(regexp_split_to_array(t, '[^A-Za-z0-9_]+')) AS w FROM f WHERE NOT staff)
SELECT DISTINCT t AS term FROM f WHERE staff AND len(t) >= 3 AND regexp_matches(t, '[A-Za-z]')
 AND lower(t) NOT IN (SELECT lower(t) FROM f WHERE NOT staff) AND (contains(t, ' ') OR t NOT IN (SELECT w FROM w))""")
def staff_terms_query(spark, sf_dir):
    """Option texts of staff keys that are used nowhere else."""
    options = table(spark, sf_dir, "part").select(F.expr(_KEY).alias("question_key"), F.expr(_TEXT).alias("text"))
    return staff_terms(options)


@query("staff_options", f"""SELECT p_partkey, k AS question_key FROM (SELECT p_partkey, {_KEY} AS k FROM part) a
 WHERE k = 'wardname'""")
def staff_options(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.expr(_KEY).alias("question_key"))
    return df.filter(~is_staff_key_col(F.col("question_key")))


@query("scrub_table_terms", r"""WITH terms AS (SELECT n_name AS t FROM nation)
SELECT s_suppkey, note AS before, CASE WHEN s_nationkey % 2 = 0 THEN concat('seen by [staff], ward ', cast(s_suppkey % 9 AS string))
 ELSE concat('seen by X', n_name, '_1') END AS after FROM (SELECT s.*, n.n_name, CASE WHEN s_nationkey % 2 = 0
 THEN concat('seen by ', n_name, ', ward ', cast(s_suppkey % 9 AS string)) ELSE concat('seen by X', n_name, '_1') END AS note
 FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey) x""")
def scrub_table_terms(spark, sf_dir):
    """Terms read from a (small) table and removed from another one."""
    nation = table(spark, sf_dir, "nation")
    patterns = term_patterns([r["n_name"] for r in bounded_rows(nation.select("n_name"), what="term list")])
    note = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("seen by "), "n_name", F.lit(", ward "),
                                                          (F.col("s_suppkey") % 9).cast("string"))
                  ).otherwise(F.concat(F.lit("seen by X"), "n_name", F.lit("_1")))
    df = table(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    return df.select("s_suppkey", note.alias("before"), scrub_terms(note, patterns).alias("after"))
