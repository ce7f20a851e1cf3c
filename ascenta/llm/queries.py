"""The queries of the corpus operators with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import bpe, exact, html, mixing, near, quality, rules, suffix, tokenbin, urls

#: The tree of the mix, root first, and the integer weights of its named nodes; others weigh 1.
MIX_LEVELS = {"domain": mixing.GENRE, "lang": "lang", "source": "source"}
MIX_WEIGHTS = {"domain": {"book": 2, "article": 5, "note": 3}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (2, 3), 2, 42
#: The rules of the url contract: host, then path.
URL_RULES = {"block": ["net/", "example.com/de/"], "allow": ["example.net/en/", "org/fr/"]}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score_quality(docs, quality.train_quality(docs, labels))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(_table(spark, sf_dir, "documents"), near.Similarity(words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.suffix_dedup(_table(spark, sf_dir, "documents"), length=100)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tokenbin.encode_corpus(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The genre and the tokens are all that is needed of the texts.
    domain = F.expr(MIX_LEVELS["domain"]).alias("domain")
    docs = _table(spark, sf_dir, "documents").select("doc_id", domain, "lang", "source", mixing.word_tokens().alias("n"))
    drawn = mixing.mix_sources(docs, {name: F.col(name) for name in MIX_LEVELS}, MIX_SHARE, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED, tokens=F.col("n"))
    return drawn.select("doc_id", "domain", "lang", "source", "mix_tokens", "mix_copies")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return urls.filter_urls(pages, URL_RULES, model=urls.train_url_model(urls.unigram_shares(pages)))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(_table(spark, sf_dir, "pages"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = bpe.encode_bpe(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, decode=True)
    return back.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_url_filter": op7_url_filter,
    "op8_html_text": op8_html_text,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality_rules": op10_quality_rules,
}

_OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), r AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size,
         row_number() OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id NULLS LAST) = 1 AS kept
  FROM d
)
SELECT doc_id, keep_id, group_size, kept, sha256(bare) AS text_sha256 FROM r
"""

_OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

#: Bytes as pairs of hex digits, since SQL slices text; windows are cut out of pieces of 256 starts, so that no long text is copied for each.
_OP4_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), piece AS (
  SELECT doc_id, n, k, substr(h, 512 * k + 1, 710) AS part FROM (SELECT *, unnest(range((n - 99 + 255) // 256)) AS k FROM d WHERE n >= 100)
), w AS (
  SELECT doc_id, 256 * k + q AS p, row_number() OVER (PARTITION BY substr(part, 2 * q + 1, 200) ORDER BY doc_id, 256 * k + q) > 1 AS again
  FROM (SELECT *, unnest(range(least(256, n - 99 - 256 * k))) AS q FROM piece)
), r AS (
  SELECT doc_id, p, lag(p) OVER o AS before, lead(p) OVER o AS after FROM w WHERE again WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), removed AS (
  SELECT doc_id, sum(least(100, coalesce(after - p, 100))) AS n_removed, count(*) FILTER (WHERE before IS NULL OR p - before > 100) AS n_spans FROM r GROUP BY doc_id
), cut AS (
  SELECT doc_id, p + 100 AS a, after AS b FROM r WHERE after IS NULL OR after - p > 100
  UNION ALL SELECT doc_id, 0, min(p) FROM r GROUP BY doc_id
  UNION ALL SELECT doc_id, 0, NULL FROM d WHERE doc_id NOT IN (SELECT doc_id FROM r)
), kept AS (
  SELECT doc_id, string_agg(CASE WHEN b IS NULL THEN substr(h, 2 * a + 1) ELSE substr(h, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a) AS h FROM cut JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

_PHRASES = " OR ".join(f"contains(lower(s), '{p}')" for p in rules.BOILERPLATE)
_WORD_COUNT = r"len(list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> ''))"
_OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT k, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT k, i, (ws[i], ws[i + 1], ws[i + 2]) AS g FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), hits AS (
  SELECT DISTINCT k, unnest([i, i + 1, i + 2]) AS i
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT k, count(*) AS n FROM hits GROUP BY k
), lines AS (
  SELECT k, unnest(ls) AS s FROM w
), judged AS (
  SELECT k, length(s) AS n,
         regexp_matches(s, '[.!?:;…。！？]')
         AND len(regexp_extract_all(s, '[#*$%&<>]')) * 2 <= {_WORD_COUNT.format("s")}
         AND len(regexp_extract_all(s, '!!')) * 4 <= {_WORD_COUNT.format("s")}
         AND len(regexp_extract_all(s, '[|»›]')) * 6 <= {_WORD_COUNT.format("s")}
         AND NOT ({_PHRASES}) AS ok
  FROM lines
), clean AS (
  SELECT k, sum(n) AS total, coalesce(sum(n) FILTER (WHERE ok), 0) AS good FROM judged GROUP BY k
), c AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(total, 0) AS total, coalesce(good, 0) AS good
  FROM w LEFT JOIN rep USING (k) LEFT JOIN clean USING (k)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
       AND 100 * good >= {rules.KEEP_PERCENT} * total AS kept
FROM c
"""



def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in MIX_WEIGHTS.get(level, {}).items())
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def _share_sql(path: list[str], above: str) -> str:
    """One level of the tree: the budgets of the nodes at *path* from those of the level above."""
    keys, parent = ", ".join(path), ", ".join(path[:-1]) or "1"
    names = "_".join(p[0] for p in path)
    join = f"JOIN {above} USING ({', '.join(path[:-1])})" if path[:-1] else f"CROSS JOIN {above}"
    prefix = f"(PARTITION BY {parent} ORDER BY capacity::DOUBLE / weight, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
n_{names} AS (
  SELECT {keys}, capacity, {_weight_sql(path[-1])}::BIGINT AS weight, budget
  FROM (SELECT {keys}, sum(supply)::BIGINT * {MIX_EPOCHS} AS capacity FROM leaves GROUP BY ALL) {join}
), h_{names} AS (
  SELECT *, coalesce(sum(capacity) OVER {prefix}, 0) AS held,
         sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER {prefix}, 0) AS weighed
  FROM n_{names}
), f_{names} AS (
  SELECT *, capacity * weighed <= weight * (budget - held) AS filled FROM h_{names}
), l_{names} AS (
  SELECT *, max(budget - held) FILTER (WHERE NOT filled) OVER (PARTITION BY {parent}) AS rest, sum(weight) FILTER (WHERE NOT filled) OVER (PARTITION BY {parent}) AS open FROM f_{names}
), q_{names} AS (
  SELECT *, rest * weight // open AS floor, rest - sum(rest * weight // open) FILTER (WHERE NOT filled) OVER (PARTITION BY {parent}) AS more,
         row_number() OVER (PARTITION BY {parent}, filled ORDER BY rest * weight % open DESC, {path[-1]}) AS turn FROM l_{names}
), b_{names} AS (
  SELECT {keys}, (CASE WHEN filled THEN capacity ELSE floor + (turn <= more)::INT END)::BIGINT AS budget FROM q_{names}
)"""


_OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, source, CASE WHEN mix_tokens >= {mixing.BOOK_WORDS} THEN 'book' WHEN mix_tokens >= {mixing.ARTICLE_WORDS} THEN 'article' ELSE 'note' END AS domain, mix_tokens
  FROM (SELECT *, greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS mix_tokens FROM documents)
), leaves AS (
  SELECT domain, lang, source, sum(mix_tokens)::BIGINT AS supply FROM d GROUP BY ALL
), root AS (
  SELECT (sum(supply)::BIGINT * {MIX_SHARE[0]}) // {MIX_SHARE[1]} AS budget FROM leaves
), {_share_sql(["domain"], "root")}, {_share_sql(["domain", "lang"], "b_d")}, {_share_sql(["domain", "lang", "source"], "b_d_l")},
e AS (
  SELECT d.*, budget // supply AS whole, budget % supply AS rest
  FROM d JOIN leaves USING (domain, lang, source) JOIN b_d_l_s USING (domain, lang, source)
), o AS (
  SELECT *, sum(mix_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || whole || ':' || doc_id), doc_id, mix_tokens
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends
  FROM e
)
SELECT doc_id, domain, lang, source, mix_tokens, (whole + (ends <= rest)::INT)::BIGINT AS mix_copies
FROM o WHERE whole + (ends <= rest)::INT > 0
"""

ORACLES: dict[str, str] = {"op2_exact_dedup": _OP2_SQL, "op3_near_dedup": _OP3_SQL, "op4_suffix_dedup": _OP4_SQL, "op6_mixing": _OP6_SQL, "op10_quality_rules": _OP10_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
