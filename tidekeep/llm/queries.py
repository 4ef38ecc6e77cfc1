"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NEAR_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
heads AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sizes LEFT JOIN heads USING (doc_id)
"""


@query("op2_minhash_near_duplicates", NEAR_SQL)
def op2(spark, sf_dir):
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


LEAK_SQL = """
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
asked AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
phrases AS (
    SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
        lambda i: array_to_string(w[i:i + 9], ' '))) AS p FROM asked WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM phrases),
runs AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM words, lengths WHERE len(w) >= n),
found AS (
    SELECT DISTINCT doc_id, i, r.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM runs) r
    JOIN phrases USING (n, p)),
hits AS (SELECT doc_id, count(DISTINCT j) AS h FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS k, string_agg(item_id, ',' ORDER BY item_id) AS l
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h, 0)::BIGINT AS n_hit, coalesce(k, 0)::BIGINT AS n_items,
    sha256(coalesce(l, '')) AS items_sha256, coalesce(h, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op10_benchmark_decontamination", LEAK_SQL)
def op10(spark, sf_dir):
    from .decontaminate import mark, report

    return report(mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op5_quality_discriminant")
def op5(spark, sf_dir):
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_document_fingerprints")
def op3(spark, sf_dir):
    from .fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH own AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
last AS (SELECT d, n, max(page_id) AS m FROM own WHERE n >= 1000 GROUP BY d, n)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < m THEN m END AS refers_to, NULL::VARCHAR AS problem
FROM own LEFT JOIN last USING (d, n)
"""


@query("op9_warc_reassembly", WARC_SQL)
def op9(spark, sf_dir):
    from .warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


CHAT_SQL = """
WITH own AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place FROM own),
whole AS (
    SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY place) AS turns FROM placed GROUP BY conv_id),
gone AS (
    SELECT DISTINCT s.conv_id FROM whole s JOIN whole l ON s.turns[1] = l.turns[1] AND s.conv_id <> l.conv_id AND s.n <= l.n
        AND l.turns[1:s.n] = s.turns AND (s.n < l.n OR l.conv_id < s.conv_id)),
kept AS (SELECT * FROM placed WHERE conv_id NOT IN (SELECT conv_id FROM gone))
SELECT conv_id, place // 512 AS segment, min(place) AS first_turn, count(*) AS n_turns,
    string_agg('<|' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '< |')
        || '<|end|>' || chr(10), '' ORDER BY place) AS rendered
FROM kept GROUP BY conv_id, place // 512
"""


@query("op4_chat_snapshot_collapse", CHAT_SQL)
def op4(spark, sf_dir):
    from .chat import collapse

    return collapse(table(spark, sf_dir, "conversations"))


@query("op7_subword_lattice_score")
def op7(spark, sf_dir):
    from .lmscore import scores

    return scores(table(spark, sf_dir, "documents"))


@query("op8_soft_membership_mixing")
def op8(spark, sf_dir):
    from pyspark.sql import functions as F

    from .mixing import TARGETS, labelled_domains, mix

    domains = labelled_domains(table(spark, sf_dir, "labels"), ["quality", "toxic"])
    mixed, names = mix(table(spark, sf_dir, "documents").select("doc_id", "text"), domains, TARGETS)
    shares = [F.col("posterior")[k].alias("p_" + d.replace("/", "_")) for k, d in enumerate(names)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


@query("op1_pii_surrogates")
def op1(spark, sf_dir):
    from .pii import anonymise

    return anonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_license_scan")
def op6(spark, sf_dir):
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents"))


PHRASE_SQL = """
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
runs AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i, w FROM runs),
one AS (SELECT lang, x, count(*) AS f FROM words GROUP BY ALL),
two AS (SELECT lang, x, w[i + 1] AS y, count(*) AS f FROM words WHERE len(w) > i GROUP BY ALL),
three AS (SELECT lang, x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM words WHERE len(w) > i + 1 GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
cut AS (
    SELECT t.lang, [t.x, t.y] AS g, t.f AS a, p.f AS l, q.f AS r, 1 AS cut FROM two t JOIN one p ON p.lang = t.lang AND p.x = t.x
    JOIN one q ON q.lang = t.lang AND q.x = t.y WHERE t.f >= 10
    UNION ALL SELECT t.lang, [t.x, t.y, t.z], t.f, p.f, q.f, 1 FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.x
    JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
    UNION ALL SELECT t.lang, [t.x, t.y, t.z], t.f, p.f, q.f, 2 FROM three t JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y
    JOIN one q ON q.lang = t.lang AND q.x = t.z),
cuts AS (SELECT *, len(g) AS k, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cut),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
around AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, g[1:2] AS g, a FROM worst WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM worst WHERE k = 3) GROUP BY ALL),
kept AS (
    SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, score FROM worst w LEFT JOIN around o
    ON o.lang = w.lang AND o.g = w.g WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_phrase_collocations", PHRASE_SQL)
def op11(spark, sf_dir):
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


AUDIT_SQL = """
WITH own AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low,
        list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > low THEN 16 ELSE 0 END) AS mask,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM own LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS step)),
sums AS (
    SELECT part, filter_order, step, own,
        sum(CASE WHEN mask & before = 0 AND mask & own = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM sums
"""


@query("op12_filter_interaction_audit", AUDIT_SQL)
def op12(spark, sf_dir):
    from .interaction import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_best_fit_packing")
def op13(spark, sf_dir):
    from .packing import digests

    return digests(table(spark, sf_dir, "documents"))
