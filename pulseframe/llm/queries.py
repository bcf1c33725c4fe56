"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dedup, gif, html, langid, lexical, licenses, merkle, packing, pieces, quality, simhash, urls, warc
from .common import UPPER, table

Query = Callable[[SparkSession, str], DataFrame]


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_back = langid.held_out(F.col("doc_id"))
    known = langid.profiles(docs.where(~kept_back))
    return langid.identify(docs, known).select("doc_id", kept_back.alias("held_out"), "lang_pred", "score")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


EXACT_DEDUP_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


WARC_INDEX_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
first AS (SELECT h, min(page_id) AS r FROM p WHERE strlen(h) >= 100 GROUP BY h HAVING count(*) > 1)
SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN r <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r <> page_id THEN r END AS refers_to
FROM p LEFT JOIN first USING (h)
"""


#: Captures and dated list entries, both made from pages. Each page is fetched at a time that follows from its id. Each
#: host has dates that follow from its digest: when lists add, drop and add it again; and each domain is
#: added to a list and dropped half a year later.
CAPTURES_SQL = """
SELECT page_id AS capture_id, url,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST((page_id * 7919) % 8760 AS INTEGER) AS TIMESTAMP) AS fetched
FROM pages
"""
CAPTURES_SPARK = CAPTURES_SQL.replace("TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST((page_id * 7919) % 8760 AS INTEGER)", "timestampadd(HOUR, cast((page_id * 7919) % 8760 as int), TIMESTAMP '2024-01-01 00:00:00')")
_NUMBER = {"spark": "cast(conv(substr(md5(host), {a}, 6), 16, 10) as bigint)", "duckdb": "CAST('0x' || substr(md5(host), {a}, 6) AS BIGINT)"}
_DAY = {"spark": "date_add(DATE '2024-01-01', cast({n} as int))", "duckdb": "CAST(DATE '2024-01-01' + CAST({n} AS INTEGER) AS DATE)"}
_DOMAIN = {"spark": "regexp_extract(host, '([^.]+[.][^.]+)$', 1)", "duckdb": "regexp_extract(host, '([^.]+[.][^.]+)$', 1)"}
_HOST = {"spark": "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))", "duckdb": "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"}


def entries_sql(engine: str) -> str:
    number, day = _NUMBER[engine], _DAY[engine]
    k = lambda a: number.format(a=a)
    rows = [
        ("list_name", "host", "'add'", day.format(n="a"), "TRUE"),
        ("list_name", "host", "'remove'", day.format(n="a + b"), "a % 3 <> 0"),
        ("list_name", "host", "'add'", day.format(n="a + b + 20"), "a % 6 = 1"),
        ("'adult'", "host", "'add'", day.format(n="b"), "b % 7 = 0"),
    ]
    parts = [f"SELECT {n} AS list_name, {p} AS pattern, {act} AS action, {d} AS effective FROM hosts WHERE {w}" for n, p, act, d, w in rows]
    parts += [f"SELECT DISTINCT 'domain' AS list_name, {_DOMAIN[engine]} AS pattern, {act} AS action, {day.format(n=n)} AS effective FROM hosts" for act, n in (("'add'", 150), ("'remove'", 300))]
    return f"""WITH hosts AS (SELECT DISTINCT host, {k(1)} % 330 AS a, 1 + {k(7)} % 120 AS b,
    CASE {k(13)} % 3 WHEN 0 THEN 'spam' WHEN 1 THEN 'malware' ELSE 'phishing' END AS list_name
    FROM (SELECT {_HOST[engine]} AS host FROM pages WHERE url IS NOT NULL) u WHERE host <> '')
{" UNION ALL ".join(parts)}"""


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = spark.sql(CAPTURES_SPARK.replace("FROM pages", "FROM {pages}"), pages=pages)
    entries = spark.sql(entries_sql("spark").replace("FROM pages", "FROM {pages}"), pages=pages)
    return urls.filter_captures(captures, entries)


URL_FILTER_SQL = f"""
WITH captures AS ({CAPTURES_SQL}), entries AS ({entries_sql("duckdb")}),
changes AS (SELECT list_name, pattern, effective, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(effective) OVER (PARTITION BY list_name, pattern ORDER BY effective) AS until FROM changes),
own AS (SELECT capture_id, fetched, {_HOST["duckdb"]} AS host FROM captures),
met AS (SELECT capture_id, list_name, effective FROM own JOIN spans ON action = 'add' AND (host = pattern OR ends_with(host, '.' || pattern))
        AND effective <= fetched AND (until IS NULL OR fetched < until)),
verdict AS (SELECT capture_id, count(*) AS n, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists, CAST(max(effective) AS TIMESTAMP) AS since FROM met GROUP BY 1)
SELECT capture_id, host, fetched, coalesce(n, 0) AS n_active, coalesce(lists, '') AS lists, since, coalesce(n, 0) > 0 AS blocked
FROM own LEFT JOIN verdict USING (capture_id)
"""


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("text", "lang", "source", "n_chars")


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_ids", "ids_crc32", "score", "round_trip", "ids")


def media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gif.media_columns(docs).select("doc_id", *gif.NAMES)


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LEXICAL_SEARCH_SQL = f"""
WITH terms AS (SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
  UNION ALL SELECT 'i', item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) FROM benchmark),
tf AS (SELECT kind, id, term, count(*) AS n FROM terms GROUP BY ALL),
docs AS (SELECT id, CAST(sum(n) AS BIGINT) AS n FROM tf WHERE kind = 'd' GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM docs),
held AS (SELECT term, count(*) AS df FROM tf WHERE kind = 'd' GROUP BY 1),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM held, total),
m AS (SELECT id, 100 - 25 + (25 * n * total.docs) // len AS m FROM docs, total),
scores AS (SELECT i.id AS item_id, d.id AS doc_id, CAST(sum(i.n * w * ((1000000000 * d.n) // (1000 * d.n + 12 * m))) AS BIGINT) AS score
  FROM tf i JOIN tf d ON i.kind = 'i' AND d.kind = 'd' AND i.term = d.term JOIN weight ON weight.term = i.term JOIN m ON m.id = d.id GROUP BY 1, 2),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_RULES_SQL = ", ".join(f"{{'rule': '{r.name}', 'value': {r.value.format(div='//')}, 'cutoffs': {list(r.cutoffs)}}}" for r in quality.RULES)
QUALITY_RULES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
cut AS (SELECT r, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda w: w <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM d),
places AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS k FROM cut),
windows AS (SELECT r, k, w || ' ' || lead(w, 1) OVER x || ' ' || lead(w, 2) OVER x || ' ' || lead(w, 3) OVER x || ' ' || lead(w, 4) OVER x AS w FROM places WINDOW x AS (PARTITION BY r ORDER BY k)),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, w) AS n FROM windows WHERE w IS NOT NULL) x WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + 5)) AS p FROM twice) x GROUP BY 1),
seen AS (SELECT r, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[ \\t-\\r]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d JOIN cut USING (r) LEFT JOIN covered USING (r)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, [{_RULES_SQL}] AS rules FROM seen),
known AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1),
valued AS (SELECT coalesce('=' || lang, '-') AS stratum, quality = 1 AS good, unnest(rules) AS x FROM base JOIN known USING (doc_id) WHERE NOT base_failed),
steps AS (SELECT stratum, good, x['rule'] AS rule, x['value'] AS v, unnest(x['cutoffs']) AS cutoff FROM valued),
counted AS (SELECT stratum, rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS n_bad, count(*) FILTER (good AND v > cutoff) AS k, count(*) FILTER (NOT good AND v > cutoff) AS k_bad FROM steps GROUP BY ALL),
tails AS (SELECT *, CASE WHEN k > n * {quality.ALPHA / len(quality.RULES)} THEN 1 ELSE (SELECT sum(exp((CASE WHEN n > 0 THEN lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) ELSE 0 END) + i * ln({quality.ALPHA / len(quality.RULES)}) + (n - i) * ln(1 - {quality.ALPHA / len(quality.RULES)}))) FROM (SELECT unnest(range(0, k + 1)) AS i) t) END AS p FROM counted),
tested AS (SELECT *, bool_and(p <= {quality.DELTA / len(quality.RULES)} / (SELECT count(DISTINCT stratum) FROM counted)) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) AS passes FROM tails),
best AS (SELECT stratum, rule, cutoff, k_bad * n - k * n_bad AS gain, row_number() OVER (PARTITION BY stratum, rule ORDER BY k_bad * n - k * n_bad DESC, cutoff DESC) AS place FROM tested WHERE passes),
failed AS (SELECT r, string_agg(b.rule, ',' ORDER BY list_position({[r.name for r in quality.RULES]}, b.rule)) AS failed_rules
  FROM (SELECT r, coalesce('=' || lang, '-') AS stratum, unnest(rules) AS x FROM base) y JOIN best b ON b.stratum = y.stratum AND b.rule = y.x['rule'] AND place = 1 AND gain > 0 AND x['value'] > cutoff GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, coalesce(failed_rules, '') AS failed_rules, NOT base_failed AND failed_rules IS NULL AS kept FROM base LEFT JOIN failed USING (r)
"""


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


#: CRC-32 of an ASCII text, a bit at a time: each character is xored in and followed by eight shifts.
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), lambda ch: [(unicode(ch) + 256)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: xor((CASE WHEN x > 0 THEN xor(c, x - 256) ELSE c END) >> 1, CASE WHEN (CASE WHEN x > 0 THEN xor(c, x - 256) ELSE c END) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"


def merkle_sql(levels: int = 8, upper: int = 4) -> str:
    """Trees of up to 16 ** levels documents of a source and 16 ** upper sources; levels above a tree's root change nothing."""
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    digest = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    parts = [f"""d AS (SELECT doc_id, coalesce('=' || source, '-') AS key, {digest("text")} AS leaf,
  CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {digest(lower)} ELSE {digest("text")} END AS given FROM documents),
d0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM d),
n0 AS (SELECT key, pos, leaf AS hash, n FROM d0)"""]
    run = "SELECT key, pos // 16 AS pos, n, list(hash ORDER BY pos) AS run FROM {} GROUP BY key, pos // 16, n"
    up = "SELECT key, pos, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS hash, CASE WHEN n > 1 THEN (n + 15) // 16 ELSE 1 END AS n FROM {}"
    for k in range(levels):
        parts += [f"r{k} AS ({run.format(f'n{k}')})", f"n{k + 1} AS ({up.format(f'r{k}')})"]
    parts.append(f"m0 AS (SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS pos, hash, count(*) OVER () AS n, key AS name FROM n{levels})")
    for k in range(upper):
        parts += [f"q{k} AS ({run.format(f'm{k}')})", f"m{k + 1} AS ({up.format(f'q{k}')})"]
    parts.append("f0 AS (SELECT doc_id, leaf, key, pos, given AS cur, '' AS proof FROM d0)")

    def step(out: str, own: str, runs: str) -> str:
        left, right = "run[1:(f.pos % 16)]", "run[(f.pos % 16) + 2:]"
        return f"""{out} AS (SELECT doc_id, leaf, f.key, f.pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(array_to_string({left}, '') || cur || array_to_string({right}, '')) ELSE cur END AS cur,
  proof || CASE WHEN n > 1 THEN array_to_string({left}, '') || array_to_string({right}, '') ELSE '' END AS proof{{also}} FROM {own} f JOIN {runs} r ON r.key = f.key AND r.pos = f.pos // 16)"""

    parts += [step(f"f{k + 1}", f"f{k}", f"r{k}").format(also="") for k in range(levels)]
    parts.append(f"g0 AS (SELECT doc_id, leaf, m0.key, m0.pos, cur, proof, hash AS subroot FROM f{levels} f JOIN m0 ON m0.name = f.key)")
    parts += [step(f"g{k + 1}", f"g{k}", f"q{k}").format(also=", subroot") for k in range(upper)]
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, m.hash AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = m.hash AS verified FROM g{upper}, m{upper} m"


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_html_extraction": html_extraction,
        "op2_warc_index": warc_index,
        "op3_url_filter": url_filter,
        "op4_simhash_near_dedup": simhash_near_dedup,
        "op5_license_scan": license_scan,
        "op6_sentencepiece": sentencepiece,
        "op7_language_id": language_id,
        "op8_exact_dedup": exact_dedup,
        "op9_media_columns": media_columns,
        "op10_best_fit_packing": best_fit_packing,
        "op11_lexical_search": lexical_search,
        "op12_quality_rules": quality_rules,
        "op13_merkle_manifest": merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_index": WARC_INDEX_SQL, "op3_url_filter": URL_FILTER_SQL, "op8_exact_dedup": EXACT_DEDUP_SQL, "op11_lexical_search": LEXICAL_SEARCH_SQL, "op12_quality_rules": QUALITY_RULES_SQL, "op13_merkle_manifest": merkle_sql()}
