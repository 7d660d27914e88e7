"""The registered queries of this subpackage, each over its whole table, and their DuckDB counterparts."""

import public_tokenizers
from pyspark.sql import functions as F

from admetrics.llm import bitpack, bpe, filter_audit, html_text, langid, lm_scoring, quality_rules, ranked_search, sharding, simhash, tiling
from admetrics.llm import url_filters, warc

#: The tokenizer of the encoding queries: where its file is, how many ids it has, and the id written after each document.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = 50_257
END_ID = 2
#: Shards of the sharding query.
SHARDS = 40

#: Rules of the URL query: fixed values.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _read(spark, sf_dir, table, *columns):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def held_out(doc_id):
    """A quarter of the documents that no model learns from; an unknown id is neither held out nor learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def op1_langid(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))), TOKENIZER)
    found = langid.predict(docs.select("doc_id", "text"), model, TOKENIZER)
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_bitpack(spark, sf_dir):
    return bitpack.read_files(bitpack.write_files(_read(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, VOCABULARY, END_ID))


def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, bits=4)


def op4_bpe(spark, sf_dir):
    fields = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode_texts(_read(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, fields=fields).select("doc_id", *fields)


def op5_lm_scoring(spark, sf_dir):
    """The target are the documents labelled as good, but for those held out."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    good = _read(spark, sf_dir, "labels", "doc_id", "quality").where((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    found = lm_scoring.score_counted(docs, good)
    return found.select("doc_id", "n_tokens", "target_loss", "background_loss", "score")


def op6_warc(spark, sf_dir):
    archives = warc.write_archives(_read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_html_text(spark, sf_dir):
    found = html_text.extract(_read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(_read(spark, sf_dir, "documents", "doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op9_decontamination(spark, sf_dir):
    """The pairs of a document and a benchmark item that it contains; clean documents have no row."""
    found = tiling.contaminated(_read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles", "n_covered")


def op10_url_filters(spark, sf_dir):
    rules = url_filters.rules_frame(spark, URL_RULES)
    judged = url_filters.judge_urls(_read(spark, sf_dir, "pages", "page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_ranked_search(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return ranked_search.search(docs, _read(spark, sf_dir, "benchmark", "item_id", "text"), k=10)


def op12_sharding(spark, sf_dir):
    """Shards of equal bytes by source, language and length."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars")
    found = sharding.assign(docs, ("source", "lang", "n_chars"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_filter_audit(spark, sf_dir):
    checked, tables = filter_audit.failing(_read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    marks = {"good": filter_audit.labelled(checked, labels.where("quality = 1")), "toxic": filter_audit.labelled(checked, labels.where("toxic = 1"))}
    return filter_audit.audit(checked, tables, marks)


QUERIES = {
    "op1_langid": op1_langid,
    "op2_bitpack": op2_bitpack,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_warc": op6_warc,
    "op7_html_text": op7_html_text,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontamination": op9_decontamination,
    "op10_url_filters": op10_url_filters,
    "op11_ranked_search": op11_ranked_search,
    "op12_sharding": op12_sharding,
    "op13_filter_audit": op13_filter_audit,
}

_WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
sums AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS x, min(page_id) OVER (PARTITION BY body) AS first_id FROM payloads)
SELECT page_id, payload_bytes,
  translate(
    to_base(('0x' || x[1:10])::BIGINT, 32, 8) || to_base(('0x' || x[11:20])::BIGINT, 32, 8)
      || to_base(('0x' || x[21:30])::BIGINT, 32, 8) || to_base(('0x' || x[31:40])::BIGINT, 32, 8),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM sums
"""

_STOP_WORDS_SQL = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))


def _fails_sql(rule):
    sides = [f"{rule.measure} {sign} {bound}" for sign, bound in (("<", rule.least), (">", rule.most)) if bound is not None]
    latin = f" AND other_letter_ratio <= {quality_rules._OTHER}" if rule.latin else ""
    return f"(({' OR '.join(sides)}) AND n_words >= {rule.from_words}{latin})"


def _any_sql(rules):
    return " OR ".join(map(_fails_sql, rules))


def quality_sql(table="documents"):
    """The counts and verdicts of the quality rules, from the same threshold table."""
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {table}),
cut AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM cut)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS s(k) GROUP BY r),
counts AS (
  SELECT cut.r, doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(regexp_replace(t, '[\x{{00}}-\x{{036F}}]+', '', 'g'), '[^\p{{L}}\p{{M}}]+', '', 'g'))::BIGINT AS n_other_letters,
    len(list_filter(w, lambda x: lower(x) IN ({_STOP_WORDS_SQL})))::BIGINT AS n_stop_words,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (r)),
ratios AS (
  SELECT *, coalesce(letters, 0) AS word_chars,
    CASE WHEN n_words > 0 THEN coalesce(letters, 0) / n_words ELSE 0.0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_other_letters / coalesce(letters, 0) ELSE 0.0 END AS other_letter_ratio,
    CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0.0 END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
    CASE WHEN n_words > 0 THEN 100 * n_repeat_words / n_words ELSE 0.0 END AS repeat_percent
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_any_sql(quality_rules.BASE)}) AS base_failed,
  NOT ({_any_sql((*quality_rules.BASE, *quality_rules.RULES))}) AS kept
FROM ratios
"""


_URL_RULES_SQL = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)
_URL_SQL = rf"""
WITH rules(action, h, p) AS (VALUES {_URL_RULES_SQL}),
parts AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id, host, path, h || p AS rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC, action DESC) = 1
"""

_SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
asked AS (SELECT i, item_id, t, count(*) AS q FROM b GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
occurring AS (SELECT r, unnest(words) AS t FROM d),
tfs AS (SELECT r, t, count(*)::BIGINT AS tf FROM occurring SEMI JOIN asked USING (t) GROUP BY ALL),
rarity AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, total GROUP BY t),
lengths AS (SELECT r, doc_id, 100 - 75 + ((75 * len(words)::BIGINT * n_docs) // n_terms) AS m FROM d, total WHERE len(words) > 0),
scores AS (
  SELECT i, item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN rarity USING (t) JOIN tfs USING (t) JOIN lengths USING (r) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

_AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
docs AS (
  SELECT part, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM cut),
counted AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM docs GROUP BY ALL),
names(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM names a, names b, names c, names d, names e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, s::INT AS step, filter_order[s:s] AS f, filter_order[1:s - 1] AS before, filter_order[1:s] AS upto
  FROM orders, range(1, 6) AS x(s)),
found AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (translate(fails, upto, '') = fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') <> fails), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (contains(fails, f) AND translate(fails, before, '') = fails), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM found
"""

ORACLES = {
    "op6_warc": _WARC_SQL,
    "op8_quality_rules": quality_sql(),
    "op10_url_filters": _URL_SQL,
    "op11_ranked_search": _SEARCH_SQL,
    "op13_filter_audit": _AUDIT_SQL,
}
