"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.llm import (alignment, bpe, guesscost, hostrules, icws, labels, lattice, mixing, passages, phrases, quality, suffixes,
                        toxicity, urlfilter)
from cumulo.llm.common import documents, ship_code
from cumulo.sources.tables import read_table

# --- op1: URL filter --------------------------------------------------------

#: Fixed by the task.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), RULES)


def _sql_host(url: str) -> str:
    return (f"coalesce(translate(regexp_extract({url}, '://([^/?#]*)', 1), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')")


def _sql_path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '')"


def _sql_node(url: str) -> str:
    query = (rf"ltrim(regexp_replace(regexp_extract({url}, '://[^?#]*\?([^#]*)', 1), "
             "'(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '&')")
    return (f"CASE WHEN {_sql_host(url)} <> '' THEN {_sql_host(url)} || rtrim({_sql_path(url)}, '/') || "
            f"CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")


def _sql_rule(host: str, path: str, column: int) -> str:
    fits = [f"WHEN ({host} = '{r[1]}' OR ends_with({host}, '.{r[1]}')) AND starts_with({path}, '{r[2]}') "
            f"THEN '{r[0] if column else r[1] + r[2]}'" for r in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return f"CASE {' '.join(fits)} END"


OP1_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*>')) AS tag FROM pages),
named AS (
  SELECT url, CASE
    WHEN regexp_matches(tag, '(?is)^<link\s[^>]*rel\s*=\s*["'']?canonical\b')
      THEN regexp_extract(tag, '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\s[^>]*http-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?((?:&amp;|[^"''\s>;])+)', 1) END AS t FROM raw),
parts AS (
  SELECT url, t, regexp_extract(url, '^([^/?#]*)://', 1) AS scheme, {_sql_host("url")} AS h, {_sql_path("url")} AS p,
         regexp_extract(t, '^[^?#]*') AS place, regexp_extract(t, '[?#].*$') AS rest
  FROM (SELECT url, replace(t, '&amp;', '&') AS t FROM named WHERE t IS NOT NULL)),
placed AS (
  SELECT *, CASE WHEN starts_with(t, '/') THEN place
                 ELSE CASE WHEN p = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END || place END AS whole FROM parts),
straight AS (
  SELECT *, array_to_string(list_reduce(list_transform(string_split(whole, '/'), lambda s: [s]),
    lambda x, y: CASE WHEN y[1] = '.' THEN x WHEN y[1] = '..' THEN x[1:greatest(len(x) - 1, 1)] ELSE list_concat(x, y) END), '/') AS w
  FROM placed),
linked AS (
  SELECT url, CASE WHEN t = '' OR starts_with(t, '#') THEN NULL
                   WHEN starts_with(t, '//') THEN scheme || ':' || t
                   WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
                   WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
                   WHEN starts_with(t, '?') THEN scheme || '://' || h || p || t
                   ELSE scheme || '://' || h || w || rest END AS target
  FROM straight),
link AS (
  SELECT {_sql_node("url")} AS a, {_sql_node("target")} AS b FROM linked WHERE {_sql_host("target")} <> ''),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
urls AS (SELECT url FROM pages UNION ALL SELECT target FROM linked WHERE {_sql_host("target")} <> ''),
acts AS (
  SELECT DISTINCT {_sql_node("url")} AS node, {_sql_rule(_sql_host("url"), _sql_path("url"), 1)} AS action FROM urls),
reach AS (
  SELECT node, action FROM acts WHERE node IS NOT NULL AND action IS NOT NULL
  UNION SELECT b, action FROM reach JOIN both_ways ON node = a),
blocked AS (
  SELECT node FROM reach GROUP BY node HAVING bool_or(action = 'block') AND NOT bool_or(action = 'allow')),
judged AS (
  SELECT page_id, {_sql_host("url")} AS host, {_sql_path("url")} AS path, {_sql_node("url")} AS node FROM pages)
SELECT page_id, host, path, {_sql_rule("host", "path", 0)} AS rule,
       coalesce({_sql_rule("host", "path", 1)}, CASE WHEN blocked.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       ({_sql_rule("host", "path", 1)} IS NULL AND blocked.node IS NOT NULL) AS alias_of_block
FROM judged LEFT JOIN blocked ON judged.node = blocked.node
"""

# --- op2: mixing ------------------------------------------------------------


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document; see ``mixing.mix``."""
    return mixing.mix(documents(spark, sf_dir, "doc_id", "source", "text")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix' || coalesce(cast(doc_id AS varchar), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS ssize,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source),
lv AS (
  SELECT *, ssize * 2.0::DOUBLE AS cap,
         (sum(ssize) OVER () * 1.5::DOUBLE
          - coalesce(sum(ssize * 2.0::DOUBLE) OVER (ORDER BY ssize * 2.0::DOUBLE / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY ssize * 2.0::DOUBLE / w, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM src),
tg AS (
  SELECT source, ssize,
         CASE WHEN cap <= lvl * w THEN cap
              ELSE max(CASE WHEN cap > lvl * w THEN lvl END) OVER () * w END AS target
  FROM lv),
ordered AS (
  SELECT s.doc_id, s.size, t.ssize, t.target,
         CASE WHEN t.ssize > 0 THEN floor(floor(t.target) / t.ssize)::BIGINT ELSE 0 END AS full_epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN tg t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, ssize AS source_size, target::DOUBLE AS target,
       (full_epochs * size + least(size, greatest(0, floor(target)::BIGINT - full_epochs * ssize - before)))::BIGINT AS taken
FROM ordered
"""

# --- op4: repeated passages -------------------------------------------------


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document keeps; digest of the kept text."""
    return passages.remove_repeats(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# --- op3, op5: classifiers ---------------------------------------------------


def _predictions(scored: DataFrame, folds: int, held_out: int, *more: str) -> DataFrame:
    return scored.select(
        "doc_id", (labels.fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), *more)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; fold 0 of 5 is never learnt from."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    known = labels.sample(read_table(spark, sf_dir, "labels"), "quality", 5, 0, quality.TRAIN_ROWS)
    return _predictions(quality.score(docs, known), 5, 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 2 of 4 is never learnt from."""
    docs = documents(spark, sf_dir, "doc_id", "lang", "text")
    known = labels.known(read_table(spark, sf_dir, "labels"), "toxic", 4, 2)
    return _predictions(toxicity.score(docs, known), 4, 2, "threshold", "toxic")


# --- op6: BPE ---------------------------------------------------------------


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of both."""
    import public_tokenizers

    done = bpe.encode(documents(spark, sf_dir, "doc_id", "text"),
                      public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


# --- op7: host rules --------------------------------------------------------


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and host-level verdict of every document."""
    return hostrules.judge(documents(spark, sf_dir, "doc_id", "source", "text"), ["doc_id"])


OP7_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
word AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, ws FROM docs),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n
  FROM word WHERE i + 2 <= len(ws)),
rep AS (
  SELECT rid, count(DISTINCT j)::BIGINT AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM win WHERE n >= 2) GROUP BY rid),
chars AS (SELECT rid, sum(length(w))::BIGINT AS word_chars FROM word GROUP BY rid),
lines AS (
  SELECT rid, (count(*) - count(DISTINCT l))::BIGINT AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
counted AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN rep USING (rid) LEFT JOIN chars USING (rid) LEFT JOIN lines USING (rid)),
judged AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > 0.5 * n_words
          OR 2 * n_dup_lines > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS failed
  FROM counted),
hosts AS (
  SELECT source, count(*)::BIGINT AS host_docs, sum(failed::BIGINT)::BIGINT AS host_failures
  FROM judged GROUP BY source),
prior AS (SELECT avg(host_failures / host_docs) AS m, var_pop(host_failures / host_docs) AS v FROM hosts),
strength AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 1.0 END AS k FROM prior),
rates AS (SELECT hosts.*, (host_failures + m * k) / (host_docs + k) AS host_rate FROM hosts, strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       host_docs, host_failures, host_rate::DOUBLE AS host_rate, (NOT base_failed AND host_rate <= 0.5) AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

# --- op8: near-duplicate texts ----------------------------------------------


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and verdict of every document."""
    return icws.near_duplicates(documents(spark, sf_dir, "doc_id", "text")).drop("text_key")


# --- op9: embeddings --------------------------------------------------------


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every embedding."""
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings"))


# --- op10: repeated byte strings --------------------------------------------


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that every document keeps; digest of what is left."""
    return suffixes.remove_repeats(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


# --- op11: secrets ------------------------------------------------------------


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: fixed patterns and hard-to-guess values."""
    done = guesscost.find_secrets(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])
    named = "x -> concat_ws(':', x.kind, x.start, x.end)"
    kinds = F.array(*map(F.lit, guesscost.KINDS))
    placed = "named_struct('start', x.start, 'place', {}, 'end', x.end, 'kind', {})"
    every = (f"array_sort(concat(transform(base, x -> {placed.format('array_position(kinds, x.kind)', 'x.kind')}), "
             f"transform(guessed, x -> {placed.format('9L', chr(39) + 'guess' + chr(39))})))")
    return done.withColumn("kinds", kinds).select(
        "doc_id", *[F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in guesscost.KINDS],
        F.sha2(F.expr(f"array_join(transform(base, {named}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform({every}, {named}), ',')").alias("spans"))


# --- op12: collocations -------------------------------------------------------


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language; see ``phrases.collocations``."""
    return phrases.collocations(documents(spark, sf_dir, "lang", "text"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS p
  FROM documents),
ws AS (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM ws, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
freq AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE k > 1),
inner_phrases AS (
  SELECT lang, a, unnest(flatten(list_transform([2, 3, 4], lambda j:
    list_transform(range(1, k - j + 2), lambda i: CASE WHEN j < k THEN array_to_string(w[i:i + j - 1], ' ') END)))) AS phrase
  FROM cand),
longer AS (SELECT lang, phrase, max(a) AS la FROM inner_phrases GROUP BY lang, phrase),
alone AS (
  SELECT cand.* FROM cand LEFT JOIN longer USING (lang, phrase) WHERE la IS NULL OR 100 * la < 100 * a),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM alone),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE nth = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

# --- op13: alignment of tokenizers --------------------------------------------


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    import public_tokenizers

    done = alignment.align(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def _registered(query):
    """The query, with the package's code at hand on the executors."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: _registered(f) for f in (
    op1_urls, op2_mix, op3_quality, op4_passages, op5_toxicity, op6_bpe, op7_host_rules, op8_near_duplicates,
    op9_embeddings, op10_suffixes, op11_secrets, op12_phrases, op13_alignment)}

ORACLE = {
    "op1_urls": OP1_SQL,
    "op2_mix": OP2_SQL,
    "op7_host_rules": OP7_SQL,
    "op12_phrases": OP12_SQL,
}
