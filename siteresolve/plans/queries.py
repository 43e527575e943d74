"""Registered queries of the site-resolution jobs, and the SQL each must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import COUNTRIES, EXCLUDED_DOMAINS, GENERIC_TLDS, SERVICE_KEYWORDS
from .. import storage
from ..functions import fuzzy, geo, text, urls
from ..operators import balance, calibration, candidates, checks, finalize, learning, logos, pages, patterns, policies, providers, recommend, regression, reports, review, scoring, secondpass, seeds, verification
from ..sources import documents
from .adapters import load, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle)
        return f

    return keep


def _merged(raw: DataFrame) -> DataFrame:
    return providers.merge_providers(providers.valid_rows(raw), {"service_api": "service_apis", "location": "provider_locations", "language": "provider_languages"}, {"provider_name": "provider_name"})


def _listed(column: str, out: str) -> str:
    return "(SELECT provider_id, string_agg(" + column + ", '; ' ORDER BY first_pos) AS " + out + " FROM (SELECT provider_id, " + column + ", min(pos) AS first_pos FROM {raw_rows} GROUP BY ALL) GROUP BY provider_id)"


def _unknown(when: str, column: str = "provider_id"):
    """The column, with values that no other table has where ``when`` holds."""
    return F.expr(f"CASE WHEN {when} THEN 'x' || {column} ELSE {column} END")


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_normalized(x: str) -> str:
    """``text.normalized`` of text in ASCII."""
    return f"trim(regexp_replace(regexp_replace(lower({x}), '{text.LEGAL_FORMS}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


# ---- providers ------------------------------------------------------------------------------


@query(
    f"""WITH r AS (SELECT provider_id, min(provider_name) AS provider_name, count(*) AS source_rows FROM {{raw_rows}} GROUP BY 1)
    SELECT r.*, service_apis, provider_locations, provider_languages FROM r JOIN {_listed("service_api", "service_apis")} a USING (provider_id)
    JOIN {_listed("location", "provider_locations")} b USING (provider_id) JOIN {_listed("language", "provider_languages")} c USING (provider_id)"""
)
def j1_merge_providers(spark, d):
    m = _merged(load(spark, d, "raw_rows"))
    return m.select("provider_id", "provider_name", "source_rows", *[F.array_join(c, "; ").alias(c) for c in ("service_apis", "provider_locations", "provider_languages")])


@query(
    """WITH k AS (SELECT provider_id, count(*) AS n FROM {raw_rows} GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS raw_rows, CAST(sum(n) AS BIGINT) AS valid_rows, count(*) AS provider_rows, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS extra_rows, max(n) AS max_rows_per_key, CAST(0 AS BIGINT) AS skipped_rows FROM k"""
)
def j2_dedupe_report(spark, d):
    return providers.dedupe_report(load(spark, d, "raw_rows"))


@query("SELECT provider_id, count(*) AS n FROM {raw_rows} GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, provider_id LIMIT 25")
def j2_most_repeated(spark, d):
    return providers.most_repeated(load(spark, d, "raw_rows"))


_LOOKUP = """WITH x AS (SELECT * FROM {decisions}), i AS (SELECT provider_id, max_by(pos, pos) AS p FROM x WHERE provider_id <> '' GROUP BY 1), m AS (SELECT lower(provider_name) AS name, max(pos) AS p FROM x GROUP BY 1)
    SELECT r.provider_id, coalesce(i.p, m.p) AS decision_pos FROM (SELECT * FROM {results}) r LEFT JOIN i ON r.provider_id = i.provider_id LEFT JOIN m ON lower(r.provider_name) = m.name"""


@query(_LOOKUP)
def j3_lookup(spark, d):
    rows = providers.lookup(load(spark, d, "results"), load(spark, d, "decisions"))
    return rows.select("provider_id", F.col("found.pos").alias("decision_pos"))


@query(
    """SELECT count(*) AS result_rows, count(*) FILTER (s.location IS NOT NULL) AS enriched_rows, count(*) FILTER (s.location IS NULL) AS missing_rows
    FROM (SELECT * FROM {results}) r LEFT JOIN (SELECT * FROM {providers}) s ON r.provider_id = CASE WHEN s.segment = 'MACHINERY' THEN 'x' ELSE '' END || s.provider_id"""
)
def j4_enrich(spark, d):
    rows = providers.lookup(load(spark, d, "results"), load(spark, d, "providers").withColumns({"provider_id": _unknown("segment = 'MACHINERY'"), "provider_name": _unknown("segment = 'MACHINERY'", "provider_name")}))
    place = F.col("found.location")
    return rows.agg(F.count(F.lit(1)).alias("result_rows"), F.count_if(place.isNotNull()).alias("enriched_rows"), F.count_if(place.isNull()).alias("missing_rows"))


# SQL of what finalize() does with the address and decision forms that the adapters make
_FINAL = """x AS (SELECT * FROM {decisions}), i AS (SELECT provider_id, max_by(struct_pack(d := manual_decision, u := manual_url, n := notes), pos) AS f FROM x WHERE provider_id <> '' GROUP BY 1),
    m AS (SELECT lower(provider_name) AS name, max_by(struct_pack(d := manual_decision, u := manual_url, n := notes), pos) AS f FROM x GROUP BY 1),
    j AS (SELECT r.*, coalesce(i.f, m.f) AS f, coalesce(i.f, m.f) IS NOT NULL AS has FROM (SELECT * FROM {results}) r LEFT JOIN i ON r.provider_id = i.provider_id LEFT JOIN m ON lower(r.provider_name) = m.name),
    k AS (SELECT *, lower(trim(coalesce(f.d, ''))) AS raw, coalesce(f.u, '') AS mu, coalesce(f.n, '') AS notes,
            regexp_replace(CASE WHEN official_url = '' THEN '' WHEN official_url LIKE 'http%' THEN official_url ELSE 'https://' || official_url END, '[.]+$', '') AS own0 FROM j),
    l AS (SELECT *, CASE WHEN own0 LIKE '%/login/x' THEN regexp_replace(own0, 'login/x$', '') ELSE own0 END AS own,
            CASE WHEN mu = '' THEN '' ELSE 'https:' || regexp_replace(mu, '[.]+$', '') END AS given,
            CASE WHEN raw = '' AND mu <> '' THEN 'replace' WHEN raw = '' THEN '' WHEN raw = 'no' THEN 'reject' WHEN raw IN ('accept', 'replace') THEN raw ELSE 'invalid:' || raw END AS d FROM k),
    g AS (SELECT *, CASE WHEN d = 'accept' AND mu = '' THEN own ELSE given END AS u FROM l),
    final AS (SELECT provider_id, CASE WHEN d = 'reject' THEN 'rejected' WHEN d IN ('accept', 'replace') AND u <> '' THEN 'manual_accepted' WHEN d IN ('accept', 'replace') THEN 'unresolved' WHEN d LIKE 'invalid:%' THEN 'invalid_manual_decision' WHEN status = 'matched' THEN 'matched' ELSE 'unresolved' END AS status,
        CASE WHEN d = 'reject' THEN 'manual_reject' WHEN d IN ('accept', 'replace') AND u <> '' THEN 'manual_' || d WHEN d IN ('accept', 'replace') THEN 'manual_' || d || '_missing_url' WHEN d LIKE 'invalid:%' THEN 'invalid_manual_decision' WHEN status = 'matched' THEN 'auto_matched' ELSE 'pending_review' END AS decision_source,
        CASE WHEN d IN ('accept', 'replace') THEN u WHEN d = '' AND status = 'matched' THEN own ELSE '' END AS official_url, confidence, status AS source_status,
        CASE WHEN d IN ('accept', 'replace') AND u = '' THEN concat_ws('; ', nullif(notes, ''), 'manual_' || d || '_missing_url') WHEN d LIKE 'invalid:%' THEN concat_ws('; ', nullif(notes, ''), d) ELSE notes END AS notes FROM g),
    final_rows AS (SELECT *, regexp_replace(regexp_extract(official_url, '^https://([^/]*)', 1), '^www[.]', '') AS official_domain FROM final)"""


def _final(spark, d):
    return finalize.finalize(load(spark, d, "results"), load(spark, d, "decisions"))


@query(f"WITH {_FINAL} SELECT provider_id, official_url, official_domain, status, decision_source, source_status, confidence, notes FROM final_rows")
def j5_finalize(spark, d):
    return _final(spark, d).select("provider_id", "official_url", "official_domain", "status", "decision_source", "source_status", "confidence", "notes")


@query(f"WITH {_FINAL} SELECT status, decision_source, count(*) AS n, count(*) FILTER (official_url <> '') AS official_url_rows FROM final_rows GROUP BY 1, 2")
def j6_final_summary(spark, d):
    return finalize.final_summary(_final(spark, d))


@query(f"WITH {_FINAL} SELECT provider_id, status FROM final_rows WHERE official_url = '' OR status = 'rejected'")
def j6_unresolved(spark, d):
    return finalize.unresolved(_final(spark, d)).select("provider_id", "status")


@query(
    """SELECT status, count(*) AS n, min(TRY_CAST(confidence AS DOUBLE)) AS min_confidence, max(TRY_CAST(confidence AS DOUBLE)) AS max_confidence, round(avg(TRY_CAST(confidence AS DOUBLE)), 1) AS avg_confidence FROM {results} GROUP BY 1"""
)
def a1_audit(spark, d):
    return finalize.audit(load(spark, d, "results"))


@query(
    f"""WITH {_FINAL}, c AS (SELECT count(*) AS rows, count(*) FILTER (official_url <> '') AS official_url_rows, count(*) FILTER (official_url = '' OR status = 'rejected') AS unresolved_rows,
        count(*) FILTER (official_domain = 'linkedin.com') AS excluded_urls, count(*) FILTER (status IN ('matched', 'manual_accepted') AND official_url = '') AS accepted_without_url, count(*) FILTER (status = 'invalid_manual_decision') AS invalid_decisions FROM final_rows),
    e AS (SELECT *, round(official_url_rows / rows, 3) AS url_rate, round(unresolved_rows / rows, 3) AS unresolved_rate FROM c)
    SELECT *, CAST(0 AS BIGINT) AS duplicate_ids, CAST(0 AS BIGINT) AS unknown_statuses, CAST(0 AS BIGINT) AS malformed_urls,
        concat_ws('; ', CASE WHEN excluded_urls > 0 THEN 'excluded_urls' END, CASE WHEN accepted_without_url > 0 THEN 'accepted_without_url' END, CASE WHEN invalid_decisions > 0 THEN 'invalid_decisions' END, CASE WHEN url_rate < 0.5 THEN 'url_rate' END, CASE WHEN unresolved_rate > 0.6 THEN 'unresolved_rate' END) AS failures FROM e"""
)
def a3_quality_gate(spark, d):
    return finalize.quality_gate(_final(spark, d), EXCLUDED_DOMAINS)


@query(
    """SELECT provider_id, status, CASE WHEN status = 'needs_review' THEN 0 ELSE 1 END AS queue FROM {results} WHERE status <> 'matched'"""
)
def r1_review_queue(spark, d):
    return finalize.review_queue(load(spark, d, "results")).select("provider_id", "status", "queue")


@query(
    """WITH x AS (SELECT *, CASE WHEN provider_id <> '' THEN 'id:' || provider_id ELSE 'name:' || lower(provider_name) END AS k FROM {decisions}), y AS (SELECT k, max(pos) AS pos, 1 AS s FROM x WHERE manual_decision <> '' GROUP BY 1 UNION ALL SELECT k, max(pos), 2 FROM x WHERE manual_decision = '' GROUP BY 1)
    SELECT k AS entity, max_by(pos, s) AS pos FROM y GROUP BY 1"""
)
def j7_combine_decisions(spark, d):
    rows = load(spark, d, "decisions")
    both = providers.combine_by_key([rows.filter("manual_decision <> ''"), rows.filter("manual_decision = ''")])
    return both.select(providers.entity_key().alias("entity"), "pos")


@query("SELECT r.provider_id FROM {results} AS r WHERE r.provider_id NOT IN (SELECT provider_id FROM {decisions})".replace("{results} AS r", "(SELECT * FROM {results}) r"))
def s12_resume(spark, d):
    return providers.resume(load(spark, d, "results"), load(spark, d, "decisions")).select("provider_id")


@query("SELECT provider_id, pos FROM {results} ORDER BY pos LIMIT 100 OFFSET 200")
def s12_page(spark, d):
    return providers.page_of(load(spark, d, "results"), 200, 100).select("provider_id", "pos")


# ---- text, urls, places ---------------------------------------------------------------------


@query(
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(replace(replace(replace(coalesce(text, ''), 'ß', ''), '¡', ''), '¿', '')), '[^\x00-\x7F]', '', 'g')), '\b(private limited|pvt ltd|pvt\. ltd\.|pte ltd|pte\. ltd\.|sp\.?\s*z\s*o\.?\s*o\.?|s\.?\s*r\.?\s*l\.?|limited|ltd|llc|llp|inc|corp|corporation|gmbh|sarl|aps|srl|sl|sas|ag|bv|plc|oy|ab|co\.?|company)\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS normalized FROM {documents}"""
)
def t2_normalized(spark, d):
    return load(spark, d, "documents").select("doc_id", text.normalized(F.col("text")).alias("normalized"))


@query(r"SELECT p_partkey, replace(p_name, ' ', '') AS slug, len(list_filter(string_split(p_name, ' '), lambda x: length(x) >= 3)) AS n_tokens FROM {part}")
def t3_t4_slug_tokens(spark, d):
    name = text.normalized(F.col("p_name"))
    return load(spark, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), F.size(text.tokens_of(name)).cast("long").alias("n_tokens"))


@query(
    r"""WITH h AS (SELECT page_id, url, regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '^www[.]', '') AS host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM {pages}), p AS (SELECT *, string_split(host, '.') AS l FROM h)
    SELECT page_id, host AS domain, CASE WHEN len(l) >= 3 AND l[-2] IN ('co', 'com', 'net', 'org') THEN l[-3] WHEN len(l) >= 2 THEN l[-2] ELSE l[1] END AS label, CASE WHEN len(l) < 2 THEN '' WHEN len(l) >= 3 AND l[-2] IN ('co', 'com', 'net', 'org') THEN l[-2] || '.' || l[-1] ELSE l[-1] END AS suffix,
    regexp_replace(host || path, '/+$', '') AS site_key FROM p"""
)
def t5_t6_t7_t11_domains(spark, d):
    u = F.col("url")
    name = urls.domain(u)
    return load(spark, d, "pages").select("page_id", name.alias("domain"), urls.base_label(name).alias("label"), urls.suffix(name).alias("suffix"), urls.site_key(u).alias("site_key"))


@query(
    r"""SELECT doc_id, len(l) AS n, coalesce(array_to_string(list_transform(l, lambda x: regexp_replace(x, '[.,);\]]+$', '')), ' '), '') AS urls FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?i)(https?://[^\s"''<>]+|www\.[^\s"''<>]+|[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)*\.(?:com|co|io|net|org|de|fr|it|es|in|pk|uk|nl|pl|ae|ca|au|us|cn|jp|sg|br|mx|tr|eu)\b)') AS l FROM {documents})"""
)
def t8_mentions(spark, d):
    rows = load(spark, d, "documents").select("doc_id", urls.mentioned(F.col("text")).alias("l"))
    return rows.select("doc_id", F.size("l").cast("long").alias("n"), F.array_join("l", " ").alias("urls"))


@query(
    r"""WITH h AS (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '/.,)' WHEN 1 THEN ';x=1' ELSE '' END AS given, url, regexp_extract(url, '^(https?)://', 1) AS s, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM {pages}), o AS (SELECT *, CASE WHEN host LIKE 'www.%' THEN substr(host, 5) ELSE 'www.' || host END AS other, CASE WHEN s = 'https' THEN 'http' ELSE 'https' END AS s2 FROM h)
    SELECT page_id, concat_ws(' ', s || '://' || host, s || '://' || other, s2 || '://' || host, s2 || '://' || other) AS roots, regexp_replace(regexp_replace(lower(s) || '://' || host || regexp_extract(regexp_replace(given, '[.,)]+$', ''), '^https?://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/+$', '') AS compared FROM o"""
)
def t10_t13_roots(spark, d):
    return load(spark, d, "pages").select("page_id", F.array_join(urls.roots(F.col("url")), " ").alias("roots"), urls.compared(F.expr("url || CASE page_id % 3 WHEN 0 THEN '/.,)' WHEN 1 THEN ';x=1' ELSE '' END")).alias("compared"))


@query(
    """WITH p AS (SELECT provider_id, location, CASE location WHEN 'Germany' THEN 'DE' WHEN 'United Kingdom' THEN 'GB' WHEN 'Ukraine' THEN 'GB,UA' WHEN 'Brasil' THEN 'BR' WHEN 'France' THEN 'FR' WHEN 'Poland' THEN 'PL' WHEN 'Atlantis' THEN '' ELSE 'US' END AS codes FROM {providers})
    SELECT provider_id, codes, CASE WHEN codes = '' THEN 'neutral' WHEN codes = 'DE' THEN 'match' ELSE 'conflict' END AS de_signal,
    CASE codes WHEN 'DE' THEN 5 WHEN 'GB' THEN 5 WHEN 'GB,UA' THEN 9 WHEN 'BR' THEN 5 WHEN 'FR' THEN 5 WHEN 'PL' THEN 5 WHEN 'US' THEN 5 ELSE 0 END AS n_terms FROM p"""
)
def t16_t17_t19_places(spark, d):
    where = F.array("location")
    found = geo.profiles(where)
    return load(spark, d, "providers").select(
        "provider_id", F.array_join(F.transform(found, lambda p: p["code"]), ",").alias("codes"), geo.domain_signal(F.lit("shop.de"), where).alias("de_signal"), F.size(geo.search_terms(where)).alias("n_terms")
    )


@query(
    """WITH b AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS h FROM {embeddings})
    SELECT a.vec_id, CAST(len(list_filter(range(1, 65), lambda i: substr(a.h, CAST(i AS INT), 1) = substr(b.h, CAST(i AS INT), 1))) AS DOUBLE) / 64 AS share FROM b a JOIN b ON b.vec_id = a.vec_id + 1"""
)
def t24_logo_similarity(spark, d):
    bits = load(spark, d, "embeddings").select("vec_id", F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "").alias("h"))
    other = bits.select((F.col("vec_id") - 1).alias("vec_id"), F.col("h").alias("g"))
    return bits.join(other, "vec_id").select("vec_id", text.fuzzy_hash_share(F.col("h"), F.col("g")).alias("share"))


# hashes of 64 bits from the vectors' signs; every 9th is a copy of its predecessor with some bits turned
_HASHES = """h0 AS (SELECT vec_id, CASE WHEN vec_id % 9 = 0 AND vec_id > 0 THEN vec_id - 1 ELSE vec_id END AS src FROM {embeddings}),
    h1 AS (SELECT h0.vec_id, array_to_string(list_transform(range(1, 65), lambda i: CASE WHEN (e.embedding[i] > 0) <> (h0.src <> h0.vec_id AND i % 9 = 0 AND i <= h0.vec_id % 80) THEN '1' ELSE '0' END), '') AS h FROM h0 JOIN {embeddings} e ON e.vec_id = h0.src)"""
_ALIKE = "len(list_filter(range(1, 65), lambda i: substr({a}, CAST(i AS INT), 1) = substr({b}, CAST(i AS INT), 1)))"


def _hashes(spark, d):
    own = load(spark, d, "embeddings").select("vec_id", F.expr("CASE WHEN vec_id % 9 = 0 AND vec_id > 0 THEN vec_id - 1 ELSE vec_id END").alias("src"))
    rows = own.join(load(spark, d, "embeddings").select(F.col("vec_id").alias("src"), "embedding"), "src")
    turned = lambda i: (F.col("src") != F.col("vec_id")) & ((i + 1) % 9 == 0) & (i < F.col("vec_id") % 80)
    return rows.select("vec_id", logos.packed(F.array_join(F.transform("embedding", lambda x, i: F.when((x > 0) != turned(i), "1").otherwise("0")), "")).alias("hash"))


@query(f"WITH {_HASHES} SELECT a.vec_id AS query_id, b.vec_id AS id, CAST({_ALIKE.format(a='a.h', b='b.h')} AS DOUBLE) / 64 AS share FROM h1 a JOIN h1 b ON {_ALIKE.format(a='a.h', b='b.h')} >= 57 WHERE a.vec_id % 20 < 2 OR a.vec_id % 9 = 0")
def t24_near_logos(spark, d):
    rows = _hashes(spark, d)
    asked = rows.filter("vec_id % 20 < 2 OR vec_id % 9 = 0").withColumnRenamed("vec_id", "query_id")
    return logos.near_logos(asked, rows.withColumnRenamed("vec_id", "id"))


@query(
    f"""WITH {_HASHES}, l AS (SELECT p.vec_id, (SELECT max(vec_id) FROM {{embeddings}}) + 1 AS n, list_transform(range(0, 8), lambda k: (p.vec_id * 3 + k * 7 + CASE WHEN k = 5 THEN 1 ELSE 0 END)) AS ks FROM {{embeddings}} p),
    t AS (SELECT vec_id, k, CASE WHEN k = 2 AND vec_id % 9 = 8 THEN vec_id + 1 ELSE (ks[k + 1] % n) END AS logo FROM l, (SELECT unnest(range(0, 8)) AS k)),
    u AS (SELECT vec_id, logo, min(k) AS k FROM t GROUP BY 1, 2), v AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY k) AS r FROM u),
    s AS (SELECT v.vec_id, v.k, v.logo, CAST({_ALIKE.format(a='a.h', b='b.h')} AS DOUBLE) / 64 AS share FROM v JOIN h1 a ON a.vec_id = v.vec_id JOIN h1 b ON b.vec_id = v.logo WHERE r <= 6),
    b AS (SELECT vec_id, min(struct_pack(s := -share, k := k, logo := logo)) AS best FROM s GROUP BY 1)
    SELECT vec_id, -best.s >= 0.88 AS matched, -best.s < 0.88 AND round(-best.s, 3) >= 0.78 AS near, round(-best.s, 3) AS score, CASE WHEN -best.s >= 0.88 THEN 18 WHEN round(-best.s, 3) >= 0.78 THEN 8 ELSE 0 END AS points, 'L' || best.logo AS logo_url FROM b"""
)
def t24_best_logos(spark, d):
    hashes = _hashes(spark, d)
    n = load(spark, d, "embeddings").agg(F.max("vec_id") + 1).first()[0]
    ids = hashes.select("vec_id")
    shown = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.concat(F.lit("L"), F.when((k == 2) & (F.col("vec_id") % 9 == 8), F.col("vec_id") + 1).otherwise((F.col("vec_id") * 3 + k * 7 + F.when(k == 5, 1).otherwise(0)) % n).cast("string")))
    pages_of = ids.select(F.concat(F.lit("P"), "vec_id").alias("url"), shown.alias("logos"))
    listed = ids.select(F.col("vec_id").alias("provider_id"), F.lit(0).alias("pos"), F.concat(F.lit("L"), "vec_id").alias("listing_logo_url"), F.concat(F.lit("P"), "vec_id").alias("url"))
    found = logos.best_logos(listed, pages_of, hashes.select(F.concat(F.lit("L"), "vec_id").alias("logo_url"), "hash"))
    return found.select(F.col("provider_id").alias("vec_id"), "matched", "near", "score", "points", "logo_url").filter("logo_url IS NOT NULL")


# ---- candidates -----------------------------------------------------------------------------


def _providers(spark, d):
    return load(spark, d, "providers").withColumns({"provider_locations": F.array("location"), "service_apis": F.array("segment")})


_TERMS = "(VALUES " + ", ".join(
    f"('{place}', {_sql_list(list(dict.fromkeys(t for c in hit for t in c[3][:3] + c[4][:2]))[:5]) if hit else 'CAST([] AS VARCHAR[])'})"
    for place in ("Germany", "United Kingdom", "Ukraine", "Atlantis", "Brasil", "France", "Poland", "United States of America")
    for hit in [[c for c in COUNTRIES if any(geo._plain(n) in geo._plain(place) for n in c[1])]]
) + ") AS t(location, terms)"


@query(
    rf"""WITH q AS (SELECT provider_id, segment, location, '"' || trim(regexp_replace(provider_name, '\s+', ' ', 'g')) || '"' AS q, replace({_sql_normalized("provider_name")}, ' ', '') AS slug FROM {{providers}}),
    l AS (SELECT provider_id, list_concat([q || ' official website', q || ' Amazon service provider', q || ' "' || segment || '"', q || ' Seller Central', q || ' "' || location || '" website'], list_transform(CAST(terms AS VARCHAR[]), lambda x: q || ' "' || x || '"'), CASE WHEN slug <> '' THEN [slug || ' website'] ELSE [] END) AS l FROM q JOIN {_TERMS} USING (location)),
    u AS (SELECT provider_id, unnest(l[1:10]) AS query, unnest(range(0, len(l[1:10]))) AS query_pos FROM l) SELECT provider_id, CAST(query_pos AS INT) AS query_pos, query FROM u"""
)
def c1_queries(spark, d):
    return candidates.query_rows(candidates.build_queries(_providers(spark, d)), 10)


@query(
    """WITH n AS (SELECT least(6, 5 + CASE location WHEN 'Atlantis' THEN 1 ELSE 6 END) AS n FROM {providers})
    SELECT count(*) AS providers, round(avg(n), 2) AS avg_queries, CAST(sum(n) AS BIGINT) AS search_requests, CAST(sum(n) * 3 AS BIGINT) AS search_candidates, count(*) * 8 AS page_bound FROM n"""
)
def c2_workload(spark, d):
    return candidates.workload(candidates.build_queries(_providers(spark, d)))


@query(
    """WITH s AS (SELECT provider_id, regexp_replace(lower(provider_name), '[^a-z0-9]+', '', 'g') AS s FROM {providers})
    SELECT provider_id, 0 AS guess_pos, 'https://www.' || s || '.com' AS url FROM s UNION ALL SELECT provider_id, 1, 'https://' || s || '.com' FROM s"""
)
def c4_domain_guesses(spark, d):
    return candidates.domain_guesses(load(spark, d, "providers"))


@query("SELECT provider_id, pos, 'www.shop' || (pos % 5) || '.de' AS url, source || '_snippet_url' AS source, url AS evidence_url FROM {candidates}")
def c5_mentioned_sites(spark, d):
    return candidates.mentioned_sites(load(spark, d, "candidates")).select("provider_id", "pos", "url", "source", "evidence_url")


@query("SELECT provider_id, min(pos) AS pos FROM {candidates} GROUP BY provider_id, regexp_replace(url, '/+$', '')")
def c6_dedupe(spark, d):
    return candidates.dedupe_candidates(load(spark, d, "candidates")).select("provider_id", "pos")


@query(
    """WITH g AS (SELECT *, source = 'domain_guess' AS guess, count(*) FILTER (source = 'domain_guess') OVER (PARTITION BY provider_id) AS n_guess, row_number() OVER (PARTITION BY provider_id, source = 'domain_guess' ORDER BY pos) AS rn FROM {candidates})
    SELECT provider_id, pos FROM g WHERE guess OR rn <= greatest(6 - n_guess, 0)"""
)
def c7_cap(spark, d):
    return candidates.cap_candidates(load(spark, d, "candidates"), 6).select("provider_id", "pos")


@query("SELECT provider_id, pos, reject AS excluded FROM {candidates}")
def c8_excluded(spark, d):
    return load(spark, d, "candidates").select("provider_id", "pos", urls.excluded(F.col("url"), EXCLUDED_DOMAINS).alias("excluded"))


# ---- scores ---------------------------------------------------------------------------------



# what the adapter's locations say, from the fixed country values
_PLACES = "(VALUES " + ", ".join(
    f"('{place}', {_sql_list(t for c in hit for t in c[2])}, {_sql_list(dict.fromkeys([geo._plain(n) for c in hit for n in c[1]] + [geo._plain(place)]))})"
    for place in ("Germany", "United Kingdom", "Ukraine", "Atlantis", "Brasil", "France", "Poland", "United States of America")
    for hit in [[c for c in COUNTRIES if any(geo._plain(n) in geo._plain(place) for n in c[1])]]
) + ") AS l(location, tlds, markers)"
_SERVICES = _sql_list(geo._plain(w) for w in SERVICE_KEYWORDS)
_SCORED = f"""p AS (SELECT provider_id, name, replace(name, ' ', '') AS short, list_filter(string_split(name, ' '), lambda x: length(x) >= 3) AS words, CAST(tlds AS VARCHAR[]) AS tlds, markers
      FROM (SELECT *, {_sql_normalized("provider_name")} AS name FROM (SELECT * FROM {{providers}}) q) q JOIN {_PLACES} USING (location)),
    c AS (SELECT provider_id, pos, source, pos % 7 AS rank, regexp_extract(lower(url), '^https?://(?:www[.])?([^/]*)', 1) AS domain, {_sql_normalized("title || ' ' || snippet")} AS said FROM {{candidates}}),
    d AS (SELECT *, CASE WHEN domain LIKE '%.co.uk' THEN split_part(domain, '.', -3) ELSE split_part(domain, '.', -2) END AS label, CASE WHEN domain LIKE '%.co.uk' THEN 'co.uk' ELSE split_part(domain, '.', -1) END AS suffix FROM c),
    s AS (SELECT *, list_filter(words, lambda x: contains(label, x)) AS in_label, list_filter(words, lambda x: contains(said, x)) AS in_said, len(list_filter({_SERVICES}, lambda x: contains(said, x))) AS services,
        {{like_label}} AS like_label, {{like_said}} AS like_said FROM d JOIN p USING (provider_id)),
    rules AS (SELECT *, list_filter([
        CASE WHEN short <> '' AND short = label THEN struct_pack(p := 35, r := 'domain_exact_provider_slug') WHEN short <> '' AND (contains(label, short) OR contains(short, label)) THEN struct_pack(p := 25, r := 'domain_contains_provider_slug')
          WHEN like_label >= 92 THEN struct_pack(p := 24, r := 'domain_fuzzy_provider_match') WHEN len(in_label) > 0 THEN struct_pack(p := CAST(least(22, 8 * len(in_label)) AS INT), r := 'domain_token_match:' || array_to_string(in_label[1:4], ',')) END,
        CASE WHEN name <> '' AND contains(said, name) THEN struct_pack(p := 15, r := 'search_result_contains_exact_name') WHEN like_said >= 90 THEN struct_pack(p := 12, r := 'search_result_fuzzy_name_match')
          WHEN len(words) > 0 AND len(in_said) >= least(2, len(words)) THEN struct_pack(p := 8, r := 'search_result_contains_name_tokens') END,
        CASE WHEN rank BETWEEN 1 AND 3 AND source <> 'domain_guess' THEN struct_pack(p := 8, r := 'top_search_result') END,
        CASE WHEN rank BETWEEN 1 AND 5 THEN struct_pack(p := 6, r := 'official_website_query_hit') END,
        CASE WHEN services >= 3 THEN struct_pack(p := 8, r := 'search_snippet_contains_amazon_service_keywords') WHEN services > 0 THEN struct_pack(p := 3, r := 'search_snippet_contains_some_service_keywords') END,
        CASE WHEN list_contains({_sql_list(GENERIC_TLDS)}, suffix) THEN NULL WHEN list_contains(tlds, suffix) THEN struct_pack(p := 6, r := 'domain_tld_matches_provider_country')
          WHEN len(tlds) > 0 AND list_contains({_sql_list(sorted({t for c in COUNTRIES for t in c[2]}))}, suffix) THEN struct_pack(p := -8, r := 'domain_tld_conflicts_provider_country') END,
        CASE WHEN len(list_filter(markers, lambda m: contains(said, m))) > 0 THEN struct_pack(p := 4, r := 'search_result_contains_provider_country') END
        ], lambda x: x IS NOT NULL) AS rules, domain = 'facebook.com' AS reject FROM s)
    SELECT provider_id, pos, domain, reject, CAST(CASE WHEN reject THEN -100 ELSE coalesce(list_sum(list_transform(rules, lambda x: x.p)), 0) END AS INT) AS score,
      CASE WHEN reject THEN 'excluded_domain' ELSE array_to_string(list_append(list_transform(rules, lambda x: x.r), 'not_fetched_preliminary_score'), '; ') END AS reasons FROM rules"""
# shared words of all words, as text.similarity has it
_WORDS = "CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 100.0 ELSE len(list_intersect(string_split({a}, ' '), string_split({b}, ' '))) * 100.0 / len(list_distinct(list_concat(string_split({a}, ' '), string_split({b}, ' ')))) END"


def _to_score(spark, d):
    own = scoring.provider_features(_providers(spark, d).select("provider_id", "provider_name", "provider_locations")).select("provider_id", "own")
    rows = load(spark, d, "candidates").drop("score", "reject").join(own, "provider_id")
    return rows.withColumns({"rank": (F.col("pos") % 7).cast("int"), "query": F.lit('"x" official website')})


@query("WITH " + _SCORED.replace("{like_label}", _WORDS.replace("{a}", "name").replace("{b}", "label")).replace("{like_said}", _WORDS.replace("{a}", "name").replace("{b}", "said")))
def g6_scores(spark, d):
    return scoring.score_candidates(_to_score(spark, d)).select("provider_id", "pos", "domain", "reject", "score", F.array_join("reasons", "; ").alias("reasons"))



# pairs of names by the token-set rule; the common subsequence grows a row of a plain table per step
_NAME_PAIRS = "(SELECT DISTINCT a.p_name || CASE WHEN a.p_size % 3 = 0 THEN ' shop' ELSE '' END AS a, CASE WHEN b.p_size % 4 = 0 THEN b.p_name || ' shop' ELSE replace(b.p_name, 'e', '') END AS b FROM {part} a JOIN {part} b ON b.p_partkey = a.p_partkey + 1)"


@query(
    f"""WITH RECURSIVE n AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM {_NAME_PAIRS}),
    t AS (SELECT a, b, array_to_string(list_sort(list_intersect(x, y)), ' ') AS common, array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(y, v))), ' ') AS one,
        array_to_string(list_sort(list_filter(y, lambda v: NOT list_contains(x, v))), ' ') AS other FROM n),
    w AS (SELECT a, b, one, other, CAST(0 AS BIGINT) AS i, list_transform(range(0, length(other) + 1), lambda j: CAST(0 AS BIGINT)) AS row FROM t
      UNION ALL
      SELECT a, b, one, other, i + 1, list_transform(range(1, length(other) + 2), lambda j: list_max(grown[1:j])) FROM (
        SELECT *, list_transform(range(1, length(other) + 2), lambda j: CASE WHEN j > 1 AND other[j - 1] = one[i + 1] THEN greatest(row[j], row[j - 1] + 1) ELSE row[j] END) AS grown FROM w WHERE i < length(one))),
    c AS (SELECT a, b, list_max(row) AS lcs FROM w WHERE i = length(one)),
    k AS (SELECT *, length(common) AS n, CASE WHEN common = '' THEN 0 ELSE 1 END AS gap, length(one) AS p, length(other) AS q FROM t JOIN c USING (a, b))
    SELECT a, b, CASE WHEN contains(a, b) OR contains(b, a) OR (n > 0 AND (p = 0 OR q = 0)) THEN 100.0 ELSE round(greatest(100 - 100.0 * (p + q - 2 * lcs) / (2 * (n + gap) + p + q), CASE WHEN n > 0 THEN 100 - 100.0 * (gap + p) / (2 * n + gap + p) ELSE 0 END,
      CASE WHEN n > 0 THEN 100 - 100.0 * (gap + q) / (2 * n + gap + q) ELSE 0 END), 6) END AS similarity FROM k"""
)
def t15_token_set(spark, d):
    pairs = spark.sql(_NAME_PAIRS[1:-1], part=load(spark, d, "part"))
    return pairs.select("a", "b", F.round(fuzzy.token_set(F.col("a"), F.col("b")), 6).alias("similarity"))


@query()
def g6_token_set_scores(spark, d):
    return scoring.score_candidates(_to_score(spark, d), "token_set").select("provider_id", "pos", "domain", "reject", "score", F.array_join("reasons", "; ").alias("reasons"))


@query(
    """WITH v AS (SELECT *, source <> 'domain_guess' AS s, row_number() OVER (PARTITION BY provider_id ORDER BY score DESC, pos) AS n FROM {candidates} WHERE NOT reject),
    w AS (SELECT *, bool_or(s AND n <= 2) OVER (PARTITION BY provider_id) AS has, min(CASE WHEN s THEN n END) OVER (PARTITION BY provider_id) AS f FROM v)
    SELECT provider_id, pos FROM w WHERE CASE WHEN NOT has AND f IS NOT NULL THEN n <= 1 OR n = f ELSE n <= 2 END"""
)
def g7_to_inspect(spark, d):
    return scoring.to_inspect(load(spark, d, "candidates")).select("provider_id", "pos")


@query(
    """WITH b AS (SELECT provider_id, max_by(struct_pack(u := url, s := score), struct_pack(a := score, b := -pos)) FILTER (NOT reject) AS b, count(*) AS candidate_count, count(*) FILTER (NOT reject) AS scored_candidate_count FROM {candidates} GROUP BY 1),
    r AS (SELECT p.provider_id, b.b, coalesce(candidate_count, 0) AS candidate_count, coalesce(scored_candidate_count, 0) AS scored_candidate_count, CASE WHEN b.b IS NULL THEN 0 ELSE least(100, greatest(0, b.b.s)) END AS c FROM (SELECT * FROM {providers}) p LEFT JOIN b ON p.provider_id = b.provider_id)
    SELECT provider_id, CAST(c AS BIGINT) AS confidence, CASE WHEN b IS NULL THEN 'not_found' WHEN c >= 75 THEN 'matched' WHEN c >= 45 THEN 'needs_review' ELSE 'low_confidence' END AS status, CASE WHEN b IS NOT NULL AND c >= 45 THEN b.u ELSE '' END AS official_url, candidate_count, scored_candidate_count FROM r"""
)
def g10_g12_choose_best(spark, d):
    scored = load(spark, d, "candidates").withColumns({"domain": urls.domain(F.col("url")), "reasons": F.array(F.lit("x"))})
    return scoring.choose_best(load(spark, d, "providers"), scored).select("provider_id", "confidence", "status", "official_url", "candidate_count", "scored_candidate_count")


# ---- labels and balance ---------------------------------------------------------------------

_DETAILS = """o AS (SELECT *, CASE WHEN official_url = '' THEN '' WHEN official_url LIKE 'https://elsewhere%' THEN 'elsewhere.org' ELSE regexp_extract(official_url, '^https://www[.]([^/]*)', 1) END AS output_domain FROM {entity_output}),
    details AS (SELECT l.provider_id, expected_kind, expected_domain, coalesce(o.status, '') AS status, coalesce(o.confidence, '') AS confidence, coalesce(output_domain, '') AS output_domain, review_reason,
        CASE WHEN expected_kind = 'official' AND coalesce(output_domain, '') <> '' AND output_domain = expected_domain THEN 'correct_official' WHEN coalesce(output_domain, '') <> '' THEN 'false_official' WHEN expected_kind = 'official' THEN 'over_rejected' ELSE 'correct_no_official' END AS outcome
        FROM (SELECT * FROM {entity_labels}) l LEFT JOIN o ON l.provider_id = o.provider_id)"""
_SUMMARY = """count(*) AS labeled_rows, count(*) FILTER (expected_kind = 'official') AS expected_official_rows, count(*) FILTER (outcome = 'correct_official') AS correct_official_rows, count(*) FILTER (outcome = 'false_official') AS false_official_rows,
    count(*) FILTER (outcome = 'over_rejected') AS over_rejected_rows, count(*) FILTER (outcome = 'correct_no_official') AS correct_no_official_rows, count(*) FILTER (outcome IN ('correct_official', 'false_official')) AS official_output_rows,
    round(count(*) FILTER (outcome = 'correct_official') / nullif(count(*) FILTER (outcome IN ('correct_official', 'false_official')), 0), 4) AS auto_precision, round(count(*) FILTER (outcome = 'correct_official') / nullif(count(*) FILTER (expected_kind = 'official'), 0), 4) AS official_recall,
    round(count(*) FILTER (outcome IN ('correct_official', 'correct_no_official')) / nullif(count(*), 0), 4) AS overall_accuracy"""


def _details(spark, d):
    return balance.evaluate_labels(load(spark, d, "entity_labels"), load(spark, d, "entity_output"))


def _in_task(spark, d):
    lanes = load(spark, d, "entity_output").select("provider_id", "review_reason")
    return _details(spark, d).join(lanes, "provider_id", "left")


@query(f"WITH {_DETAILS} SELECT provider_id, output_domain, outcome FROM details")
def a6_outcomes(spark, d):
    return _details(spark, d).select("provider_id", "output_domain", "outcome")


@query(f"WITH {_DETAILS} SELECT {_SUMMARY} FROM details")
def a7_summary(spark, d):
    return balance.summarize(_details(spark, d))


@query(
    f"""WITH {_DETAILS}, t AS (SELECT d.* EXCLUDE (outcome, output_domain), t.threshold, CASE WHEN status = 'matched' AND output_domain <> '' AND (TRY_CAST(confidence AS DOUBLE) IS NULL OR TRY_CAST(confidence AS DOUBLE) < threshold) THEN '' ELSE output_domain END AS od FROM details d, (SELECT unnest([0, 45, 60, 75, 85, 95]) AS threshold) t),
    u AS (SELECT *, CASE WHEN expected_kind = 'official' AND od <> '' AND od = expected_domain THEN 'correct_official' WHEN od <> '' THEN 'false_official' WHEN expected_kind = 'official' THEN 'over_rejected' ELSE 'correct_no_official' END AS outcome FROM t) SELECT threshold, {_SUMMARY} FROM u GROUP BY threshold"""
)
def a8_threshold_sweep(spark, d):
    return balance.threshold_sweep(_details(spark, d), [0, 45, 60, 75, 85, 95])


@query(
    f"""WITH {_DETAILS}, c AS (SELECT count(*) FILTER (review_reason IS NOT NULL) AS reviewed_rows, count(*) FILTER (outcome = 'false_official' AND review_reason IS NOT NULL) AS false_official_captured, count(*) FILTER (outcome = 'false_official' AND review_reason IS NULL) AS false_official_missed,
    count(*) FILTER (outcome = 'over_rejected' AND review_reason IS NOT NULL) AS over_rejected_captured, count(*) FILTER (outcome = 'over_rejected' AND review_reason IS NULL) AS over_rejected_missed FROM details) SELECT *, round(false_official_captured / (false_official_captured + false_official_missed), 4) AS false_official_capture_rate FROM c"""
)
def a9_review_capture(spark, d):
    return balance.review_capture(_in_task(spark, d))


_LANES = f"""{_DETAILS}, k AS (SELECT review_reason, count(*) AS labeled_rows, count(*) FILTER (outcome = 'correct_official') AS correct_official_rows, count(*) FILTER (outcome = 'false_official') AS false_official_rows, count(*) FILTER (outcome = 'over_rejected') AS over_rejected_rows, count(*) FILTER (outcome = 'correct_no_official') AS correct_no_official_rows FROM details WHERE review_reason IS NOT NULL GROUP BY 1),
    lanes AS (SELECT r.review_reason, r.n AS review_task_rows, k.* EXCLUDE (review_reason), false_official_rows + over_rejected_rows AS risk_rows FROM (SELECT review_reason, count(*) AS n FROM {{entity_output}} WHERE review_reason IS NOT NULL GROUP BY 1) r LEFT JOIN k ON r.review_reason = k.review_reason)"""


@query(
    f"WITH {_LANES} SELECT *, round(risk_rows / nullif(labeled_rows, 0), 4) AS risk_share_of_labeled_lane, round((correct_official_rows + correct_no_official_rows) / nullif(labeled_rows, 0), 4) AS correct_share_of_labeled_lane FROM lanes"
)
def a10_review_lanes(spark, d):
    return balance.review_lanes(_in_task(spark, d), load(spark, d, "entity_output").filter("review_reason is not null"))


@query(
    f"WITH {_LANES} SELECT review_reason AS drop_review_reason, CAST(sum(review_task_rows) OVER () - review_task_rows AS BIGINT) AS manual_review_rows_after_drop, review_task_rows AS manual_review_rows_removed, false_official_rows AS known_false_official_missed, over_rejected_rows AS known_over_rejected_missed, correct_official_rows + correct_no_official_rows AS known_correct_reviews_removed FROM lanes"
)
def a11_lane_drops(spark, d):
    return balance.lane_drops(balance.review_lanes(_in_task(spark, d), load(spark, d, "entity_output").filter("review_reason is not null")))


@query(
    """WITH w AS (SELECT *, CASE manual_decision WHEN 'accept' THEN 'support' WHEN 'reject' THEN 'blocking' ELSE '' END AS o FROM {work}), x AS (SELECT 'review_reason' AS field, review_reason AS value, manual_decision, o FROM w UNION ALL SELECT 'provider_id', provider_id, manual_decision, o FROM w),
    s AS (SELECT field, value, count(*) AS rows, count(*) FILTER (manual_decision <> '') AS labeled_rows, count(*) FILTER (o = 'support') AS support_rows, count(*) FILTER (o = 'blocking') AS blocking_rows, count(*) FILTER (o <> '') AS n FROM x GROUP BY 1, 2),
    z AS (SELECT *, support_rows / n AS p, 1.2815515655446004 AS z FROM s)
    SELECT field, value, rows, labeled_rows, support_rows, blocking_rows, n AS decisive_rows, round(p, 4) AS support_rate, round(greatest(0, (p + z*z/(2*n) - z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)), 4) AS support_low, round(least(1, (p + z*z/(2*n) + z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)), 4) AS support_high FROM z"""
)
def a14_a16_group_stats(spark, d):
    rows = load(spark, d, "work").withColumn("o", F.when(F.col("manual_decision") == "accept", "support").when(F.col("manual_decision") == "reject", "blocking").otherwise(""))
    return balance.group_stats(rows, ["review_reason", "provider_id"], "manual_decision", "o")


# ---- patterns -------------------------------------------------------------------------------


def _evidence(spark, d):
    return load(spark, d, "evidence").select("row_id", "tie", F.array_compact(F.array("f1", "f2", "f3", "f4")).alias("features"), "correct").withColumn("row_id", F.struct("row_id", "tie"))


_COMBOS = """e AS (SELECT list_sort(list_filter([f1, f2, f3, f4], lambda x: x IS NOT NULL)) AS f, correct FROM {evidence}), g AS (SELECT f, count(*) AS n, count(*) FILTER (correct) AS c FROM e GROUP BY 1),
    i AS (SELECT f, n, c, unnest(range(1, CAST(pow(2, len(f)) AS BIGINT))) AS b FROM g), s AS (SELECT list_filter(f, lambda x, k: (b >> (k - 1)) & 1 = 1) AS p, n, c FROM i),
    mined AS (SELECT array_to_string(p, ' AND ') AS pattern, len(any_value(p)) AS size, CAST(sum(n) AS BIGINT) AS support_rows, CAST(sum(c) AS BIGINT) AS correct_rows, CAST(sum(n) - sum(c) AS BIGINT) AS wrong_rows, round(sum(c) / sum(n), 4) AS precision FROM s WHERE len(p) <= 3 GROUP BY 1)"""


@query(f"WITH {_COMBOS} SELECT pattern, support_rows, correct_rows, wrong_rows, precision FROM mined")
def p3_mine_patterns(spark, d):
    return patterns.mine(_evidence(spark, d), size=3).drop("features")


@query(f"WITH {_COMBOS} SELECT pattern, support_rows FROM mined WHERE wrong_rows = 0 AND support_rows >= 5")
def p5_safe_patterns(spark, d):
    return patterns.safe(patterns.mine(_evidence(spark, d), size=3, least_support=5, durable_only=True), 5).select("pattern", "support_rows")


@query(
    f"WITH {_COMBOS}, ok AS (SELECT * FROM mined WHERE wrong_rows = 0 AND support_rows >= 5) SELECT a.pattern FROM ok a WHERE NOT EXISTS (SELECT 1 FROM ok b WHERE b.size < a.size AND list_has_all(string_split(a.pattern, ' AND '), string_split(b.pattern, ' AND ')))"
)
def p6_minimal_patterns(spark, d):
    return patterns.minimal(patterns.safe(patterns.mine(_evidence(spark, d), size=3), 5)).select("pattern")


_TRIED = "(VALUES ('a', 0, ['flag:N', 'quantity>=40']), ('b', 1, ['flag:N']), ('c', 2, ['has:discount', 'status:F'])) AS t(pattern, pattern_pos, features)"


def _tried(spark):
    return spark.createDataFrame([("a", 0, ["flag:N", "quantity>=40"]), ("b", 1, ["flag:N"]), ("c", 2, ["has:discount", "status:F"])], "pattern string, pattern_pos int, features array<string>")


@query(
    f"""WITH e AS (SELECT row_id, tie, correct, [f1, f2, f3, f4] AS f FROM {{evidence}}), m AS (SELECT row_id, tie, min(pattern_pos) AS q FROM e, {_TRIED} WHERE list_has_all(e.f, t.features) GROUP BY row_id, tie)
    SELECT CASE q WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS pattern, count(*) AS n FROM m GROUP BY 1"""
)
def p4_pattern_match(spark, d):
    return patterns.matches(_evidence(spark, d), _tried(spark), "row_id").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH e AS (SELECT row_id, tie, any_value(correct) AS correct, [f1, f2, f3, f4] AS f FROM {{evidence}} GROUP BY ALL) SELECT pattern, count(*) AS released_rows, count(*) FILTER (correct) AS correct_released, count(*) FILTER (NOT correct) AS wrong_released, round(count(*) FILTER (correct) / count(*), 4) AS release_precision FROM e, {_TRIED} WHERE list_has_all(e.f, t.features) GROUP BY 1"""
)
def p8_release_simulation(spark, d):
    return patterns.release_simulation(_evidence(spark, d).dropDuplicates(["row_id", "features"]), _tried(spark))


# ---- review work ----------------------------------------------------------------------------


@query(
    """WITH r AS (SELECT provider_id, url, CASE WHEN reject THEN -100 ELSE score END AS score, row_number() OVER (PARTITION BY provider_id ORDER BY CASE WHEN reject THEN -100 ELSE score END DESC, pos) AS n FROM {candidates})
    SELECT provider_id, max(url) FILTER (n = 1) AS candidate_1_url, max(score) FILTER (n = 1) AS candidate_1_score, max(url) FILTER (n = 3) AS candidate_3_url, max(score) FILTER (n = 5) AS candidate_5_score FROM r GROUP BY 1"""
)
def r2_review_sheet(spark, d):
    rows = load(spark, d, "candidates").withColumn("domain", urls.domain(F.col("url")))
    return review.review_sheet(rows).select("provider_id", "candidate_1_url", "candidate_1_score", "candidate_3_url", "candidate_5_score")


@query(
    """WITH t AS (SELECT *, row_number() OVER (PARTITION BY review_reason ORDER BY score DESC, seq) AS turn FROM {work}), g AS (SELECT review_reason, row_number() OVER (ORDER BY max(score) DESC, review_reason) AS r FROM {work} GROUP BY 1)
    SELECT t.review_reason, t.seq, t.turn FROM t JOIN g ON t.review_reason = g.review_reason WHERE turn <= 20 ORDER BY turn, r LIMIT 42"""
)
def r9_round_robin(spark, d):
    return review.round_robin(load(spark, d, "work"), "review_reason", [F.desc("score"), F.col("seq")], 42, 20).select("review_reason", "seq", "turn")


@query("SELECT review_reason, seq FROM (SELECT *, row_number() OVER (PARTITION BY review_reason ORDER BY score DESC, seq) AS n FROM {work}) WHERE n <= 10")
def r11_top_per_reason(spark, d):
    return review.top_per_group(load(spark, d, "work"), "review_reason", [F.desc("score"), F.col("seq")], 10).select("review_reason", "seq")


@query("SELECT review_reason, seq FROM (SELECT *, row_number() OVER (PARTITION BY review_reason ORDER BY seq) AS n FROM {work} WHERE manual_decision = '') WHERE n <= length(review_reason)")
def r13_label_gap(spark, d):
    rows = load(spark, d, "work").filter("manual_decision = ''")
    targets = rows.select("review_reason").distinct().withColumn("needed", F.length("review_reason"))
    return review.label_gap(rows, targets, "review_reason", "seq").select("review_reason", "seq")


@query("SELECT provider_id, review_reason, coalesce(max(seq) FILTER (manual_decision <> ''), max(seq)) AS seq FROM {work} GROUP BY 1, 2")
def j8_merge_samples(spark, d):
    return review.merge_samples(load(spark, d, "work")).select("provider_id", "review_reason", "seq")


@query(
    """WITH l AS (SELECT provider_id, count(DISTINCT struct_pack(manual_decision, manual_url)) AS k, min_by(struct_pack(manual_decision, manual_url), seq) AS l FROM {work} WHERE manual_decision <> '' AND review_reason = 'error' AND score > 100 GROUP BY 1)
    SELECT r.provider_id, CASE WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'reused' ELSE 'conflict' END AS label_state, CASE WHEN k = 1 THEN l.manual_decision ELSE '' END AS reused_decision, CASE WHEN k = 1 THEN l.manual_url ELSE '' END AS reused_url FROM (SELECT provider_id FROM {results}) r LEFT JOIN l ON r.provider_id = l.provider_id"""
)
def j11_reuse_labels(spark, d):
    labels = load(spark, d, "work").filter("manual_decision <> '' and review_reason = 'error' and score > 100")
    return review.reuse_labels(load(spark, d, "results").select("provider_id"), labels, "seq")


@query("SELECT r.provider_id FROM (SELECT * FROM {results}) r WHERE r.provider_id NOT IN (SELECT provider_id FROM {work} WHERE manual_decision <> '')")
def j13_unfilled(spark, d):
    return review.unfilled(load(spark, d, "results"), load(spark, d, "work").filter("manual_decision <> ''")).select("provider_id")


@query(
    """WITH c AS (SELECT regexp_replace(regexp_replace(lower(url), '^https?://(www[.])?', ''), '/.*$', '') AS domain, score, source FROM {candidates}), g AS (SELECT domain, count(*) FILTER (source = 'brave' AND score > 90) AS accepted, count(*) FILTER (source <> 'brave') AS rejected FROM c GROUP BY 1)
    SELECT *, rejected >= 2 AND accepted = 0 AND domain <> 'facebook.com' AS exclude FROM g"""
)
def a20_a21_domain_feedback(spark, d):
    rows = load(spark, d, "candidates").select(urls.domain(F.col("url")).alias("domain"), F.when((F.col("source") == "brave") & (F.col("score") > 90), "accept").when(F.col("source") != "brave", "reject").alias("decision"))
    return review.domain_feedback(rows, EXCLUDED_DOMAINS)


# ---- pages ----------------------------------------------------------------------------------


_PAGE_PATHS = ["/", "/about", "/contact", "/services", "/privacy", "/terms"]


def _hosts(spark, d):
    """All pages, each under its host and, in order, a usual path of a company's site or a further one (the data's own paths don't say what a page is)."""
    seen = load(spark, d, "pages").withColumn("host", urls.host_part(F.col("url")))
    nth = F.row_number().over(Window.partitionBy("host").orderBy("page_id"))
    path = F.coalesce(F.get(F.array(*map(F.lit, _PAGE_PATHS)), nth - 1), F.concat(F.lit("/page"), nth.cast("string")))
    return seen.withColumn("path", path).withColumn("url", F.concat(F.lit("https://"), "host", "path"))


def _found_sites(hosts):
    return hosts.filter("path = '/'").select(F.col("host").alias("provider_id"), F.col("page_id").alias("pos"), "url", urls.base_label(F.col("host")).alias("provider_name"), F.array(F.lit("Germany")).alias("provider_locations"))


def _sites(spark, d):
    """Page flags of all pages, and one candidate per host named after it."""
    hosts = _hosts(spark, d)
    return _found_sites(hosts), pages.page_flags(pages.read_pages(hosts))


@query()
def g1_g2_g3_read_pages(spark, d):
    read = pages.read_pages(load(spark, d, "pages"))
    return read.select("url", "title", "meta", "h1", "nav", F.length("text").alias("text_chars"), F.size("links").alias("n_links"), F.size("organizations").alias("n_organizations"), F.array_join("logos", " ").alias("logos"))


@query()
def g4_page_flags(spark, d):
    return pages.page_flags(pages.read_pages(load(spark, d, "pages"))).drop("said").withColumn("trades", F.array_join("trades", "; "))


@query()
def g5_g8_g9_site_scores(spark, d):
    found, flags = _sites(spark, d)
    sites = pages.inspect_sites(found, flags, ["/about", "/contact", "/services"])
    rows = found.withColumns({"title": F.lit(""), "snippet": F.lit(""), "source": F.lit("brave"), "query": F.lit(""), "rank": F.lit(1)})
    return pages.full_score(scoring.score_candidates(rows), sites).select("provider_id", "url", "domain", "score", F.array_join("reasons", "; ").alias("reasons"))


# ---- second pass and verification -----------------------------------------------------------


def _planned(spark, d):
    best = load(spark, d, "candidates").filter("not reject").groupBy("provider_id").agg(F.max_by(F.struct("url", "source", "score"), F.struct("score", (-F.col("pos")).alias("p"))).alias("b"))
    rows = load(spark, d, "results").select("provider_id", "status", "confidence").join(_providers(spark, d), "provider_id").join(best, "provider_id", "left")
    rows = rows.select("*", F.col("b.url").alias("candidate_1_url"), F.col("b.source").alias("candidate_1_source"), F.col("b.score").alias("candidate_1_score")).drop("b")
    return secondpass.plan(rows.filter("status <> 'matched'"))


@query(
    """WITH b AS (SELECT provider_id, max_by(struct_pack(src := source, s := score), struct_pack(a := score, b := -pos)) AS b FROM {candidates} WHERE NOT reject GROUP BY 1), r AS (SELECT r.status, coalesce(b.b.src, '') AS src, coalesce(b.b.s, 0) AS s FROM (SELECT * FROM {results}) r LEFT JOIN b ON r.provider_id = b.provider_id WHERE r.status <> 'matched')
    SELECT CASE WHEN status = 'needs_review' THEN 'A_verify_top_candidate' WHEN status = 'not_found' THEN 'D_registry_social_then_manual' WHEN src = 'domain_guess' OR s >= 35 THEN 'B_verify_or_expand_domain_guess' ELSE 'C_broaden_search' END AS strategy_tier, status, count(*) AS rows FROM r GROUP BY 1, 2"""
)
def c9_c10_plan_summary(spark, d):
    return secondpass.plan_summary(_planned(spark, d))


_PLAN_COUNTRIES = "CASE " + " ".join(f"WHEN contains(lower(location), '{k}') THEN " + "[" + ", ".join("'" + q.replace("{n}", "' || provider_name || '") + "'" for q in qs) + "]" for k, qs in secondpass.COUNTRY_QUERIES) + " ELSE CAST([] AS VARCHAR[]) END"


@query(
    f"""WITH b AS (SELECT provider_id, max_by(struct_pack(src := source, s := score, u := url), struct_pack(a := score, b := -pos)) AS b FROM {{candidates}} WHERE NOT reject GROUP BY 1),
    r AS (SELECT r.provider_id, r.status, p.provider_name, p.segment, p.location, CAST(t.terms AS VARCHAR[]) AS terms, coalesce(b.b.src, '') AS src, coalesce(b.b.s, 0) AS s, regexp_replace(regexp_replace(lower(coalesce(b.b.u, '')), '^https?://(www[.])?', ''), '/.*$', '') AS top
      FROM (SELECT * FROM {{results}}) r JOIN (SELECT * FROM {{providers}}) p ON r.provider_id = p.provider_id JOIN {_TERMS} ON p.location = t.location LEFT JOIN b ON b.provider_id = r.provider_id WHERE r.status <> 'matched'),
    k AS (SELECT *, CASE status WHEN 'needs_review' THEN 'A_verify_top_candidate' WHEN 'not_found' THEN 'D_registry_social_then_manual' ELSE CASE WHEN src = 'domain_guess' OR s >= 35 THEN 'B_verify_or_expand_domain_guess' ELSE 'C_broaden_search' END END AS tier, '"' || provider_name || '"' AS q FROM r),
    l AS (SELECT provider_id, tier, top, list_concat([q || ' official website', q || ' website -linkedin -facebook -instagram -amazon', q || ' "contact"', q || ' "' || segment || '"', q || ' "' || location || '" website'], CASE WHEN top <> '' THEN ['site:' || top || ' ' || q, q || ' "' || top || '"'] ELSE [] END,
      {_PLAN_COUNTRIES}, list_transform(terms, lambda x: q || ' "' || x || '"'), CASE WHEN status = 'not_found' THEN [q || ' LinkedIn website', q || ' Crunchbase website'] ELSE [] END) AS l FROM k),
    u AS (SELECT provider_id, tier, top, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM l)
    SELECT provider_id, tier AS strategy_tier, top AS top_candidate_domain, """
    + ", ".join(f"coalesce(l[{k}], '') AS query_{k}" for k in range(1, 9))
    + " FROM u"
)
def c9_plan(spark, d):
    return _planned(spark, d).select("provider_id", "strategy_tier", "top_candidate_domain", *[f"query_{k}" for k in range(1, 9)])


@query(
    f"""WITH {_FINAL}, t AS (SELECT *, coalesce(TRY_CAST(nullif(confidence, '') AS INT), 0) AS c, provider_id IN (SELECT provider_id FROM {{candidates}} WHERE NOT reject) AS known FROM final_rows)
    SELECT provider_id, CASE WHEN official_url = '' AND known THEN 'recall_unresolved_top_candidate' WHEN official_url = '' THEN 'recall_unresolved_manual_search' WHEN status = 'manual_accepted' AND c < 70 THEN 'precision_second_pass_accepted_lt70' WHEN status = 'manual_accepted' AND c < 85 THEN 'precision_second_pass_accepted_70_84' WHEN status = 'manual_accepted' THEN 'precision_second_pass_accepted_85_plus'
      WHEN c < 83 THEN 'precision_low_confidence_auto_match' ELSE 'spot_check_non_matched_status' END AS review_reason FROM t WHERE official_url = '' OR CASE WHEN status = 'manual_accepted' THEN c < 85 WHEN status <> 'matched' THEN TRUE ELSE c < 83 END"""
)
def r3_review_task(spark, d):
    second = load(spark, d, "candidates").filter("not reject").select("provider_id", F.lit("").alias("provider_name"), F.lit("").alias("official_url"), F.col("url").alias("previous_top_candidate_url"), F.lit("").alias("evidence_summary"), F.lit("").alias("accepted_for_final"), "pos")
    return secondpass.review_task(_final(spark, d), second).select("provider_id", "review_reason")


@query()
def g17_page_roles(spark, d):
    rows = secondpass.page_roles(pages.read_pages(load(spark, d, "pages")))
    return rows.select("url", F.array_join("roles", "; ").alias("roles"), F.array_join("risks", "; ").alias("risks"))


@query(
    """WITH w AS (SELECT provider_id, pos, score, score - 20 AS rs, CASE pos % 4 WHEN 0 THEN 'recall_unresolved_top_candidate' WHEN 1 THEN 'precision_low_confidence_auto_match' ELSE '' END AS reason, source = 'brave' AS replaceable, reject AS counter FROM {candidates})
    SELECT provider_id, pos, CASE WHEN reason <> '' THEN 'unsure' WHEN score >= 70 AND NOT counter THEN 'accept' WHEN replaceable THEN 'replace' WHEN score <= 20 AND counter THEN 'reject' ELSE 'unsure' END AS decision,
    CASE WHEN reason LIKE 'recall%' OR (replaceable AND reason <> '') THEN greatest(0, least(69, greatest(score, rs))) WHEN reason <> '' AND counter THEN greatest(0, least(69, score)) WHEN reason <> '' THEN least(69, score) WHEN score >= 70 AND NOT counter THEN least(100, score)
      WHEN replaceable THEN greatest(70, least(95, CASE WHEN rs = 0 THEN 70 ELSE rs END)) WHEN score <= 20 AND counter THEN least(90, greatest(50, 100 - score)) ELSE greatest(0, least(69, score)) END AS confidence FROM w"""
)
def g21_verification_decision(spark, d):
    rows = load(spark, d, "candidates").withColumns(
        {
            "reason": F.when(F.col("pos") % 4 == 0, "recall_unresolved_top_candidate").when(F.col("pos") % 4 == 1, "precision_low_confidence_auto_match").otherwise(""),
            "replacement": F.when(F.col("source") == "brave", F.lit("https://r.com")).otherwise(""),
            "counters": F.when(F.col("reject"), F.array(F.lit("candidate_not_independent_official_site"))).otherwise(F.array().cast("array<string>")),
        }
    )
    made = secondpass.verification_decision(F.col("score"), F.array().cast("array<string>"), F.col("counters"), F.col("replacement"), F.col("score") - 20, F.col("reason"))
    return rows.withColumn("x", made).select("provider_id", "pos", "x.decision", "x.confidence")


@query()
def r8_balanced_sample(spark, d):
    rows = load(spark, d, "work").select("review_reason", F.concat(F.lit("p"), F.col("seq") % 5).alias("pattern_match"), "seq", "score")
    return review.balanced_sample(rows, [F.desc("score"), F.col("seq")], 60, 15, 10)


# mined patterns of the richer evidence, and the sets of features that its rows have
_LANE = """e AS (SELECT list_sort([f1, f2, f3]) AS f, correct FROM {lane_rows}), g AS (SELECT f, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (correct) AS BIGINT) AS c, row_number() OVER (ORDER BY f) AS id FROM e GROUP BY 1),
    s AS (SELECT list_filter(f, lambda x, k: (b >> (k - 1)) & 1 = 1) AS p, n, c FROM (SELECT f, n, c, unnest(range(1, 8)) AS b FROM g)),
    mined AS (SELECT array_to_string(p, ' AND ') AS pattern, p AS features, len(p) AS size, sum(n) AS support_rows, sum(n) - sum(c) AS wrong FROM s WHERE len(p) <= 2 GROUP BY ALL HAVING sum(n) >= 5)"""


def _lane(spark, d):
    rows = load(spark, d, "lane_rows").select("row_id", F.array("f1", "f2", "f3").alias("features"), "correct")
    return rows, patterns.mine(rows, size=2, least_support=5)


@query(
    f"WITH {_LANE}, m AS (SELECT g.id, g.n, min(struct_pack(w := wrong, s := -support_rows, p := pattern)) AS best FROM g JOIN mined ON list_has_all(g.f, mined.features) GROUP BY ALL) SELECT best.p AS pattern, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY 1"
)
def p4_many_patterns(spark, d):
    rows, mined = _lane(spark, d)
    listed = mined.select("pattern", "features", F.struct("wrong_rows", -F.col("support_rows")).alias("pattern_pos"))
    return patterns.matches(rows, listed, "row_id").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH RECURSIVE {_LANE}, rights AS (SELECT list(c ORDER BY id) AS c, list(n - c ORDER BY id) AS w FROM g),
    hits AS (SELECT pattern, len(any_value(features)) AS size, sum(c) AS c, sum(n - c) AS w, list(id) FILTER (c > 0) AS r_ids, list(id) FILTER (n > c) AS w_ids FROM g JOIN mined ON list_has_all(g.f, mined.features) GROUP BY 1),
    o AS (SELECT *, row_number() OVER (ORDER BY w, c DESC, size, pattern) AS k FROM hits),
    walk AS (
      SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS got, CAST([] AS BIGINT[]) AS bad, FALSE AS kept, CAST(0 AS HUGEINT) AS new_correct, CAST(0 AS HUGEINT) AS wrong_so_far, '' AS pattern
      UNION ALL
      SELECT k, CASE WHEN ok THEN list_distinct(list_concat(got, coalesce(r_ids, []))) ELSE got END, CASE WHEN ok THEN all_bad ELSE bad END, ok, new_correct, CASE WHEN ok THEN wrong ELSE wrong_so_far END, pattern FROM (
        SELECT *, new_correct > 0 AND wrong <= 150 AS ok FROM (
          SELECT o.k, walk.got, walk.bad, walk.wrong_so_far, o.r_ids, o.pattern, list_distinct(list_concat(walk.bad, coalesce(o.w_ids, []))) AS all_bad,
            coalesce(list_sum(list_transform(list_filter(o.r_ids, lambda i: NOT list_contains(walk.got, i)), lambda i: rights.c[i])), 0) AS new_correct,
            coalesce(list_sum(list_transform(list_distinct(list_concat(walk.bad, coalesce(o.w_ids, []))), lambda i: rights.w[i])), 0) AS wrong
          FROM walk JOIN o ON o.k = walk.k + 1, rights)))
    SELECT pattern, row_number() OVER (ORDER BY k) AS place, CAST(new_correct AS BIGINT) AS new_correct, CAST(wrong_so_far AS BIGINT) AS wrong_so_far FROM walk WHERE kept"""
)
def p9_actionable_set(spark, d):
    return patterns.actionable_set(*_lane(spark, d), most_wrong=150)


def _pattern_files(spark, d):
    """Two written files of different layouts: safe patterns as feature lists, and rule candidates as names, among broken entries."""
    mined = _lane(spark, d)[1].withColumn("safe", F.col("wrong_rows") == 0)
    listed = F.struct("features", F.col("support_rows"), F.lit(0).alias("wrong_release_rows"), F.col("correct_rows").alias("correct_recovery_rows"))
    named = F.struct("pattern", (F.col("support_rows") + 1).cast("string").alias("supporting_rows"), F.col("wrong_rows").alias("blocking_rows"), F.lit("").alias("scope"))
    # one document each, as the tools that make them write it
    one = mined.agg(F.sort_array(F.collect_list(F.when(F.col("safe"), listed))).alias("durable_safe_patterns"), F.sort_array(F.collect_list(F.when(F.col("support_rows") % 2 == 0, named))).alias("candidate_for_rule"), F.sort_array(F.collect_list(F.when(F.col("support_rows") % 3 == 0, named))).alias("reject_pattern"))
    docs = one.select(
        F.explode(
            F.array(
                F.struct(F.lit("a").alias("name"), F.to_json(F.struct(F.struct(F.lit("recall").alias("scope")).alias("summary"), "durable_safe_patterns", F.lit("no list").alias("all_patterns"))).alias("value")),
                F.struct(F.lit("b").alias("name"), F.to_json(F.struct(F.struct("candidate_for_rule", "reject_pattern").alias("pattern_rule_candidates"))).alias("value")),
                F.struct(F.lit("c").alias("name"), F.lit("{broken").alias("value")),
            )
        ).alias("f")
    ).select("f.*")
    folder = f"{storage.shared_dir(spark)}/patterns-{uuid.uuid4().hex[:12]}"
    docs.coalesce(1).write.partitionBy("name").text(folder)
    return documents.whole_files(spark, folder + "/*")


@query(
    f"""WITH {_LANE}, every AS (SELECT pattern, features, support_rows AS n, 0 AS w, 1 AS k FROM mined WHERE wrong = 0
      UNION ALL SELECT pattern, features, support_rows + 1, wrong, 2 FROM mined WHERE support_rows % 2 = 0 UNION ALL SELECT pattern, features, support_rows + 1, wrong, 3 FROM mined WHERE support_rows % 3 = 0)
    SELECT pattern, array_to_string(features, '|') AS features, 'recall' AS scope, CAST(arg_min(n, k) AS BIGINT) AS source_support_rows, CAST(arg_min(w, k) AS BIGINT) AS source_wrong_rows FROM every GROUP BY ALL"""
)
def p7_pattern_files(spark, d):
    return documents.pattern_table(_pattern_files(spark, d)).withColumn("features", F.array_join("features", "|"))


@query(
    f"""WITH {_LANE} SELECT pattern, CAST(support_rows + 1 AS BIGINT) AS correct_recovery_rows, CAST(wrong AS BIGINT) AS wrong_release_rows, CAST(row_number() OVER (ORDER BY support_rows DESC, wrong, size, pattern, support_rows) - 1 AS INT) AS pattern_pos FROM mined WHERE support_rows % 2 = 0"""
)
def p7_release_patterns(spark, d):
    return documents.release_patterns(_pattern_files(spark, d)).drop("features", "actionable")


@query(
    """WITH c AS (SELECT provider_id, list(struct_pack(u := url, s := score) ORDER BY pos) AS l FROM {candidates} GROUP BY 1), k AS (SELECT provider_id, CASE WHEN TRY_CAST(provider_id AS BIGINT) % 7 = 0 THEN [] ELSE l END AS l FROM c)
    SELECT r.provider_id, CAST(coalesce(len(k.l), 0) AS BIGINT) AS candidate_count, coalesce(k.l[1].u, '') AS first_url, CAST(coalesce(list_sum(list_transform(k.l, lambda x: x.s)), 0) AS BIGINT) AS score_sum FROM (SELECT * FROM {results}) r LEFT JOIN k ON r.provider_id = k.provider_id"""
)
def s7_evidence_lines(spark, d):
    nested = F.transform(F.array_sort(F.collect_list(F.struct("pos", "url", "score"))), lambda x: F.struct(x["url"].alias("url"), x["score"].cast("long").alias("score")))
    records = load(spark, d, "candidates").groupBy("provider_id").agg(nested.alias("candidates"), F.count(F.lit(1)).alias("candidate_count"))
    folder = f"{storage.shared_dir(spark)}/evidence-{uuid.uuid4().hex[:12]}"
    # every seventh line is broken off, and blank lines stand between
    line = F.when(F.col("provider_id").cast("long") % 7 == 0, F.lit('{"provider_id": "')).otherwise(F.to_json(F.struct("provider_id", "candidates", "candidate_count")))
    records.select(F.explode(F.array(line, F.lit("  "))).alias("value")).write.text(folder)
    sound, _ = documents.sound_and_broken(documents.evidence_lines(spark, folder))
    rows = documents.with_evidence(load(spark, d, "results"), sound)
    scores = F.aggregate("candidates", F.lit(0).cast("long"), lambda s, x: s + x["score"])
    return rows.select("provider_id", "candidate_count", F.coalesce(F.get("candidates", F.lit(0))["url"], F.lit("")).alias("first_url"), scores.alias("score_sum"))


_SAMPLE = """d AS (SELECT event_type || '_' || (event_id % 5) AS review_reason, CASE WHEN event_type IN ('error', 'view') THEN 'recall' ELSE 'precision' END AS lane_kind, event_id AS pos,
      CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 7 = 0 THEN 'unsure' WHEN value > 95 AND event_id % 5 < 2 THEN 'reject' ELSE 'accept' END AS normalized_decision,
      CASE WHEN event_id % 11 = 0 THEN 'invalid_manual_decision' WHEN event_id % 13 = 0 THEN 'replace_missing_manual_url' ELSE '' END AS decision_quality_issue FROM {events} WHERE event_type <> 'signup' OR event_id % 100 < 8),
    details AS (SELECT *, CASE normalized_decision WHEN '' THEN 'unlabeled' WHEN 'unsure' THEN 'manual_unsure' WHEN 'accept' THEN CASE lane_kind WHEN 'recall' THEN 'recall_candidate_useful' ELSE 'candidate_correct' END ELSE CASE lane_kind WHEN 'recall' THEN 'recall_candidate_not_useful' ELSE 'candidate_incorrect' END END AS calibration_outcome FROM d)"""


def _sample(spark, d):
    return spark.sql("WITH " + _SAMPLE + " SELECT * FROM details", events=load(spark, d, "events"))


@query(
    f"""WITH {_SAMPLE}, v AS (SELECT *, normalized_decision <> '' AND decision_quality_issue = '' AS valid FROM details),
    g AS (SELECT review_reason, arg_min(lane_kind, pos) AS lane_kind, count(*) AS rows, count(*) FILTER (valid) AS labeled_rows, count(*) FILTER (valid AND normalized_decision = 'accept') AS support_rows, count(*) FILTER (valid AND normalized_decision = 'reject') AS blocking_rows, count(*) FILTER (valid AND normalized_decision = 'unsure') AS manual_unsure_rows FROM v GROUP BY 1),
    n AS (SELECT *, support_rows + blocking_rows AS n, support_rows / nullif(support_rows + blocking_rows, 0) AS p, blocking_rows / nullif(support_rows + blocking_rows, 0) AS q, 1.2815515655446004 AS z FROM g),
    r AS (SELECT review_reason, lane_kind, rows, labeled_rows, n AS decisive_rows, support_rows, blocking_rows, manual_unsure_rows, round(p, 4) AS support_rate, round(greatest(0, (p + z*z/(2*n) - z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)), 4) AS support_rate_wilson_lower_80,
      round(least(1, (q + z*z/(2*n) + z * sqrt(q*(1-q)/n + z*z/(4*n*n))) / (1 + z*z/n)), 4) AS blocking_rate_wilson_upper_80, CASE WHEN n = 0 THEN 'unlabeled' WHEN blocking_rows > 0 THEN 'blocked' WHEN support_rows < 5 THEN 'thin_support' WHEN n < 10 THEN 'minimum_support' ELSE 'strong_support' END AS evidence_strength,
      CASE WHEN n = 0 THEN 'needs_more_labels' WHEN blocking_rows > 0 THEN 'keep_review_lane' WHEN support_rows < 5 THEN 'needs_more_labels' WHEN lane_kind = 'recall' THEN 'candidate_for_narrow_recall_rule' ELSE 'candidate_for_review_downgrade' END AS recommendation FROM n)
    SELECT *, row_number() OVER (ORDER BY list_position(['keep_review_lane', 'candidate_for_review_downgrade', 'candidate_for_narrow_recall_rule', 'needs_more_labels'], recommendation), decisive_rows DESC, review_reason) AS place FROM r"""
)
def a18_lane_recommendations(spark, d):
    rows = recommend.lane_recommendations(_sample(spark, d)).drop("candidate_correct_rows", "candidate_incorrect_rows", "recall_useful_rows", "recall_not_useful_rows")
    return rows.withColumn("place", F.row_number().over(Window.orderBy("rank")).cast("long")).drop("rank")


@query(
    f"""WITH {_SAMPLE}, v AS (SELECT *, normalized_decision <> '' AND decision_quality_issue = '' AS valid FROM details)
    SELECT count(*) AS sample_rows, count(*) FILTER (valid) AS labeled_rows, count(*) FILTER (valid AND normalized_decision <> 'unsure') AS decisive_rows, count(*) FILTER (decision_quality_issue LIKE 'invalid%') AS invalid_manual_decision_rows, count(*) FILTER (decision_quality_issue LIKE 'replace%') AS replace_missing_manual_url_rows,
      count(*) FILTER (decision_quality_issue <> '') AS decision_quality_issue_rows, count(*) FILTER (calibration_outcome = 'candidate_correct') AS candidate_correct_rows, count(*) FILTER (calibration_outcome = 'candidate_incorrect') AS candidate_incorrect_rows, count(*) FILTER (calibration_outcome = 'recall_candidate_useful') AS recall_useful_rows,
      count(*) FILTER (calibration_outcome = 'recall_candidate_not_useful') AS recall_not_useful_rows, count(*) FILTER (calibration_outcome = 'manual_unsure') AS unsure_rows FROM v"""
)
def a15_sample_summary(spark, d):
    return recommend.sample_summary(_sample(spark, d))


# one sweep per lane: a row is released at a threshold from its value; the first lanes have thresholds without wrong rows
_SWEEPS = """w AS (SELECT review_reason || '_' || (seq % 4) AS lane, t, score >= t AS out, manual_decision = 'accept' OR (seq % 4 = 0 AND score >= 75) AS ok FROM {work}, (SELECT explode_t AS t FROM thresholds)),
    sims AS (SELECT lane, t AS evidence_threshold, count(*) FILTER (WHERE out AND ok) AS correct_recovery_rows, count(*) FILTER (WHERE out AND NOT ok) AS wrong_release_rows, round(CAST(count(*) FILTER (WHERE out AND ok) AS DOUBLE) / nullif(count(*) FILTER (WHERE out), 0), 4) AS release_precision FROM w GROUP BY lane, t)"""


@query(
    "WITH thresholds AS (SELECT unnest([0, 30, 45, 60, 75, 90, 200]) AS explode_t), " + _SWEEPS + """,
    r AS (SELECT *, wrong_release_rows = 0 AND correct_recovery_rows > 0 AS clean FROM sims),
    b AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY clean DESC, CASE WHEN clean THEN 0 ELSE coalesce(release_precision, 0) END DESC, correct_recovery_rows DESC, CASE WHEN clean THEN 0 ELSE wrong_release_rows END, evidence_threshold) AS k FROM r)
    SELECT lane, CASE WHEN clean THEN 'narrow_auto_release_candidate' ELSE 'manual_only' END AS recommendation, evidence_threshold AS threshold, correct_recovery_rows, wrong_release_rows FROM b WHERE k = 1"""
)
def a28_recall_release(spark, d):
    thresholds = spark.createDataFrame([(t,) for t in (0, 30, 45, 60, 75, 90, 200)], "explode_t int")
    sims = spark.sql("WITH " + _SWEEPS.replace("{work}", "{w0}").replace("thresholds)", "{th})") + " SELECT * FROM sims", w0=load(spark, d, "work"), th=thresholds)
    return recommend.recall_release(sims, ["lane"])


@query(
    f"""WITH {_LANE}, c AS (SELECT *, features[1] AS grp, row_number() OVER (ORDER BY pattern) AS pos FROM mined), gg AS (SELECT grp, pattern AS path, support_rows - wrong AS correct, wrong, CASE WHEN wrong > 0 THEN 0.5 ELSE 0.9 END AS acc, pos FROM c),
    b AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY CASE WHEN correct > 0 AND wrong = 0 THEN 0 ELSE 1 END, wrong, correct DESC, acc DESC, path) AS k FROM gg)
    SELECT grp, path, CASE WHEN correct > 0 AND wrong = 0 THEN 'narrow_pattern_release_candidate' ELSE 'not_recommended' END AS recommendation, CAST(correct AS BIGINT) AS correct_recovery_rows, CAST(wrong AS BIGINT) AS wrong_release_rows FROM b WHERE k = 1"""
)
def a28_pattern_release(spark, d):
    mined = _lane(spark, d)[1]
    rows = mined.select(F.get("features", F.lit(0)).alias("grp"), F.col("pattern").alias("path"), F.lit(1).alias("pattern_count"), F.col("correct_rows").alias("correct_recovery_rows"), F.col("wrong_rows").alias("wrong_release_rows"), F.when(F.col("wrong_rows") > 0, 0.5).otherwise(0.9).alias("overall_accuracy"), F.col("pattern").alias("pos"))
    return recommend.pattern_release(rows, ["grp"]).select("grp", "path", "recommendation", "correct_recovery_rows", "wrong_release_rows")


@query(
    f"""WITH {_FINAL}, f AS (SELECT count(*) AS n, count(*) FILTER (official_url = '' OR status IN ('unresolved', 'rejected', 'invalid_manual_decision')) AS open, count(*) FILTER (official_url = '' OR status = 'rejected') AS listed, count(*) FILTER (CAST(provider_id AS BIGINT) % 6 = 0) AS no_detail,
      count(*) FILTER (official_domain = 'linkedin.com') AS excluded FROM final_rows), gate AS ({{gate}})
    SELECT * FROM (SELECT 'unresolved_csv_rows' AS check, listed AS found, open AS expected FROM f UNION ALL SELECT 'missing_provider_detail_url_rows', no_detail, 0 FROM f UNION ALL SELECT 'final_rows', n, 10 FROM f UNION ALL SELECT 'excluded_official_url_rows', excluded, 0 FROM f
      UNION ALL SELECT 'quality_gate', CASE WHEN failures <> '' THEN 1 ELSE 0 END, 0 FROM gate UNION ALL SELECT 'quality_total_rows', n, 10 FROM f) WHERE found <> expected""".replace("{gate}", ORACLES["a3_quality_gate"])
)
def a4_output_checks(spark, d):
    final = storage.written(_final(spark, d).withColumn("provider_detail_url", F.when(F.col("provider_id").cast("long") % 6 != 0, F.lit("https://x.org"))), "final")
    folder = f"{storage.shared_dir(spark)}/checked-{uuid.uuid4().hex[:12]}"
    return checks.output_checks(final, finalize.unresolved(final), finalize.quality_gate(final, EXCLUDED_DOMAINS), folder, expected_rows=10)


@query(
    """WITH k AS (SELECT provider_id, review_reason, count(*) AS n FROM {work} WHERE provider_id <> '' GROUP BY 1, 2), s AS (SELECT review_reason, count(*) AS n FROM {work} GROUP BY 1), w AS (SELECT count(*) AS n, count(*) FILTER (manual_decision <> '') AS filled FROM {work})
    SELECT * FROM (SELECT 'required_fields' AS check, CAST(3 AS BIGINT) AS found, CAST(0 AS BIGINT) AS expected UNION ALL SELECT 'duplicate_provider_reason', count(*), 0 FROM k WHERE n > 1 UNION ALL SELECT 'provider_detail_url', count(*) FILTER (seq % 10 = 0), 0 FROM {work} UNION ALL SELECT 'candidate_or_official_url', count(*) FILTER (manual_url = '' AND seq % 2 = 0), 0 FROM {work}
      UNION ALL SELECT 'manual_decision_blank', filled, 0 FROM w UNION ALL SELECT 'summary_task_rows', w.n, (SELECT CAST(sum(n + CASE WHEN review_reason = 'error' THEN 1 ELSE 0 END) AS BIGINT) FROM s) FROM w UNION ALL SELECT 'summary_reason_counts', 1, 0) WHERE found <> expected"""
)
def a31_task_checks(spark, d):
    work = load(spark, d, "work")
    task = work.withColumns({"provider_name": F.lit("n"), "provider_detail_url": F.when(F.col("seq") % 10 != 0, "https://x.org"), "candidate_url": F.when(F.col("seq") % 2 != 0, "https://c.org"), "official_url": F.col("manual_url")})
    summary = work.groupBy("review_reason").agg((F.count(F.lit(1)) + F.when(F.col("review_reason") == "error", 1).otherwise(0)).alias("n"))
    return checks.task_checks(task, f"{storage.shared_dir(spark)}/task-{uuid.uuid4().hex[:12]}", summary)


# ---- regression, policies -------------------------------------------------------------------

_KEY = "CASE WHEN {u} = '' THEN '' ELSE regexp_replace(regexp_replace(regexp_replace({u}, '^https?://', ''), '^www[.]', ''), '/+$', '') END"
_GATE = f"""k AS (SELECT c.*, r.official_url AS seen, {_KEY.replace("{u}", "r.official_url")} AS s, {_KEY.replace("{u}", "c.expected_url")} AS e, {_KEY.replace("{u}", "c.candidate_url")} AS b FROM (SELECT * FROM {{cases}}) c LEFT JOIN (SELECT * FROM {{results}}) r ON c.provider_id = r.provider_id),
    gated AS (SELECT provider_id, pos, case_type, CASE WHEN seen IS NULL THEN 'provider_missing_from_candidate_output' WHEN case_type LIKE '%blocking%' AND seen <> '' AND s = b THEN 'blocked_candidate_was_auto_accepted' WHEN case_type LIKE '%blocking%' AND e <> '' AND seen <> '' AND s <> e THEN 'candidate_changed_away_from_blocked_url'
      WHEN case_type LIKE '%positive%' AND seen = '' THEN 'positive_fixture_over_rejected' WHEN case_type LIKE '%positive%' AND e <> '' AND seen <> '' AND s <> e THEN 'positive_fixture_changed_to_different_site' ELSE '' END AS failure_reason FROM k),
    results_of AS (SELECT *, CASE WHEN failure_reason = 'provider_missing_from_candidate_output' THEN 'unverified' WHEN failure_reason IN ('', 'candidate_changed_away_from_blocked_url') THEN 'pass' ELSE 'fail' END AS gate_result FROM gated)"""


@query(f"WITH {_GATE} SELECT provider_id, pos, gate_result, failure_reason FROM results_of")
def p13_regression_gate(spark, d):
    return regression.gate(load(spark, d, "cases"), load(spark, d, "results")).select("provider_id", "pos", "gate_result", "failure_reason")


@query(
    f"""WITH {_GATE} SELECT count(*) AS cases, count(*) FILTER (gate_result = 'pass') AS passed, count(*) FILTER (gate_result = 'fail') AS failed, count(*) FILTER (gate_result = 'unverified') AS unverified,
    CASE WHEN count(*) FILTER (gate_result = 'fail') > 0 THEN 'failed' WHEN count(*) FILTER (gate_result = 'unverified') > 0 THEN 'unverified' ELSE 'passed' END AS gate_status FROM results_of"""
)
def p13_gate_summary(spark, d):
    return regression.gate_summary(regression.gate(load(spark, d, "cases"), load(spark, d, "results")))


@query(
    f"""WITH RECURSIVE {_FINAL}, c AS (SELECT provider_id, case_type, expected_url AS e, coalesce(nullif(candidate_url, ''), official_url) AS b, row_number() OVER (PARTITION BY provider_id ORDER BY pos) AS k FROM {{cases}}),
    walk AS (
      SELECT provider_id, CAST(0 AS BIGINT) AS k, official_url AS url, status, decision_source AS source, notes, '' AS changes FROM final_rows
      UNION ALL
      SELECT provider_id, k, CASE WHEN how IN ('replace', 'restore') THEN e WHEN how = 'block' THEN '' ELSE url END, CASE WHEN how IN ('replace', 'restore') THEN 'manual_accepted' WHEN how = 'block' THEN 'rejected' ELSE status END,
        CASE WHEN how = '' THEN source ELSE label END, CASE WHEN how = '' THEN notes ELSE concat_ws('; ', nullif(notes, ''), label || ':' || case_type) END,
        CASE WHEN how = '' THEN changes ELSE concat_ws('; ', nullif(changes, ''), CASE how WHEN 'replace' THEN 'replace_with_expected_url' WHEN 'block' THEN 'block_known_wrong_url' ELSE 'restore_known_correct_url' END) END
      FROM (SELECT *, CASE how WHEN 'replace' THEN 'calibration_regression_replace' WHEN 'block' THEN 'calibration_regression_block' ELSE 'calibration_regression_positive' END AS label FROM (
        SELECT w.* EXCLUDE (k), c.k, c.e, c.case_type, CASE WHEN contains(c.case_type, 'blocking') AND c.e <> '' AND ({_KEY.replace("{u}", "w.url")}) <> ({_KEY.replace("{u}", "c.e")}) THEN 'replace'
          WHEN contains(c.case_type, 'blocking') AND w.url <> '' AND ({_KEY.replace("{u}", "w.url")}) = ({_KEY.replace("{u}", "c.b")}) THEN 'block'
          WHEN contains(c.case_type, 'positive') AND c.e <> '' AND ({_KEY.replace("{u}", "w.url")}) <> ({_KEY.replace("{u}", "c.e")}) THEN 'restore' ELSE '' END AS how
        FROM walk w JOIN c ON c.provider_id = w.provider_id AND c.k = w.k + 1)))
    SELECT provider_id, url AS official_url, regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '/.*$', ''), '^www[.]', '') AS official_domain, status, source AS decision_source, notes, changes
    FROM (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY k DESC) AS r FROM walk) WHERE r = 1"""
)
def j14_apply_cases(spark, d):
    out = regression.apply_cases(_final(spark, d), load(spark, d, "cases"))
    return out.select("provider_id", "official_url", "official_domain", "status", "decision_source", "notes", F.array_join("changes", "; ").alias("changes"))


@query(
    f"""WITH {_FINAL}, h AS (SELECT DISTINCT provider_id FROM {{work}} WHERE review_reason IN ('error', 'view') AND score > 60)
    SELECT f.provider_id, CASE WHEN h.provider_id IS NOT NULL AND official_url <> '' THEN '' ELSE official_url END AS official_url, CASE WHEN h.provider_id IS NOT NULL AND official_url <> '' THEN 'needs_review' ELSE status END AS status FROM final_rows f LEFT JOIN h ON f.provider_id = h.provider_id"""
)
def p11_hold_lanes(spark, d):
    return regression.hold_lanes(_final(spark, d), load(spark, d, "work").filter("score > 60"), ["error", "view"]).select("provider_id", "official_url", "status")


@query(
    f"""WITH {_FINAL}, w AS (SELECT provider_id, bool_or(review_reason = 'error' AND score > 60) AS late, 'www.found' || provider_id || '.com' AS u FROM {{work}} GROUP BY 1)
    SELECT f.provider_id, CASE WHEN official_url = '' AND late THEN 'https://' || u ELSE official_url END AS official_url, CASE WHEN official_url = '' AND late THEN 'calibrated_released' ELSE status END AS status FROM final_rows f LEFT JOIN w ON f.provider_id = w.provider_id"""
)
def p10_release_by_pattern(spark, d):
    work = load(spark, d, "work").withColumn("feature", F.when((F.col("review_reason") == "error") & (F.col("score") > 60), "has:late_error").otherwise("missing:late_error"))
    evidence = work.groupBy(F.col("provider_id").alias("row_id")).agg(F.collect_set("feature").alias("features")).withColumns({"candidate_url": F.concat(F.lit("www.found"), "row_id", F.lit(".com")), "review_reason": F.lit("recall_unresolved_top_candidate")})
    listed = spark.createDataFrame([("has:late_error", 0, ["has:late_error"])], "pattern string, pattern_pos int, features array<string>")
    return regression.release_by_pattern(_final(spark, d), evidence, listed, EXCLUDED_DOMAINS).select("provider_id", "official_url", "status")


@query(
    "WITH sweep AS (" + ORACLES["a8_threshold_sweep"] + "), b AS (SELECT threshold, overall_accuracy, (SELECT overall_accuracy FROM sweep WHERE threshold = 75) AS current_accuracy FROM sweep ORDER BY overall_accuracy DESC, abs(threshold - 75), threshold LIMIT 1) SELECT threshold AS recommended_threshold, overall_accuracy, current_accuracy, round(overall_accuracy - current_accuracy, 4) AS accuracy_change FROM b"
)
def a27_threshold_choice(spark, d):
    return regression.threshold_choice(balance.threshold_sweep(_details(spark, d), [0, 45, 60, 75, 85, 95]), 75)


# ---- calibration ----------------------------------------------------------------------------


@query(
    """WITH w AS (SELECT 'p' || (seq % 40) AS pattern, CASE WHEN seq % 13 = 0 THEN 'issue' ELSE '' END AS issue, manual_decision AS d, CASE WHEN manual_decision = 'accept' THEN 1 WHEN manual_decision = 'reject' AND seq % 40 > 20 THEN 2 ELSE 0 END AS o FROM {work}),
    g AS (SELECT pattern, count(*) AS rows, count(*) FILTER (issue = '' AND d <> '') AS labeled_rows, count(*) FILTER (issue = '' AND o = 1) AS supporting_rows, count(*) FILTER (issue = '' AND o = 2) AS blocking_rows FROM w GROUP BY 1),
    z AS (SELECT *, supporting_rows + blocking_rows AS n, 1.2815515655446004 AS z FROM g)
    SELECT pattern, 'recall' AS pattern_scope, rows, labeled_rows, n AS decisive_rows, supporting_rows, blocking_rows, round(supporting_rows / nullif(n, 0), 4) AS support_rate,
      CASE WHEN n > 0 THEN round(greatest(0, (supporting_rows / n + z*z/(2*n) - z * sqrt((supporting_rows / n) * (1 - supporting_rows / n) / n + z*z/(4*n*n))) / (1 + z*z/n)), 4) END AS support_rate_wilson_lower_80,
      CASE WHEN n > 0 THEN round(least(1, (blocking_rows / n + z*z/(2*n) + z * sqrt((blocking_rows / n) * (1 - blocking_rows / n) / n + z*z/(4*n*n))) / (1 + z*z/n)), 4) END AS blocking_rate_wilson_upper_80,
      CASE WHEN blocking_rows > 0 THEN 'reject_pattern' WHEN supporting_rows >= 5 THEN 'candidate_for_rule' WHEN supporting_rows > 0 THEN 'needs_more_labels' ELSE 'unlabeled' END AS recommendation FROM z"""
)
def a17_pattern_recommendations(spark, d):
    rows = load(spark, d, "work").select(
        F.concat(F.lit("p"), F.col("seq") % 40).alias("pattern_match"),
        F.lit("recall").alias("pattern_scope"),
        F.col("seq").alias("pos"),
        F.when(F.col("seq") % 13 == 0, "issue").otherwise("").alias("decision_quality_issue"),
        F.col("manual_decision").alias("normalized_decision"),
        F.when(F.col("manual_decision") == "accept", "candidate_correct").when((F.col("manual_decision") == "reject") & (F.col("seq") % 40 > 20), "candidate_incorrect").otherwise("").alias("calibration_outcome"),
    )
    return calibration.pattern_recommendations(rows)


@query(
    f"""WITH {_DETAILS}, t AS (SELECT d.*, t.t, coalesce(TRY_CAST(confidence AS INT), 0) >= t.t AS released, expected_kind = 'official' AND output_domain = expected_domain AS ok FROM details d, (SELECT unnest([0, 30, 45, 50, 60, 70, 75, 80, 85]) AS t) t WHERE output_domain <> '')
    SELECT t AS evidence_threshold, count(*) AS recall_rows, count(*) FILTER (expected_kind = 'official') AS expected_official_rows, count(*) FILTER (released) AS release_rows, count(*) FILTER (released AND ok) AS correct_recovery_rows, count(*) FILTER (released AND NOT ok) AS wrong_release_rows, count(*) FILTER (NOT released AND ok) AS held_correct_recovery_rows,
      round(count(*) FILTER (released AND ok) / nullif(count(*) FILTER (released), 0), 4) AS release_precision, round(count(*) FILTER (released AND ok) / nullif(count(*) FILTER (expected_kind = 'official'), 0), 4) AS official_recovery_rate FROM t GROUP BY 1"""
)
def a13_recall_releases(spark, d):
    rows = _details(spark, d).select("expected_kind", "expected_domain", F.col("output_domain").alias("candidate_domain"), text.whole_number(F.col("output_confidence")).alias("candidate_score"))
    return calibration.recall_releases(rows)


@query(
    """WITH l AS (SELECT review_reason, count(*) AS rows, count(*) FILTER (manual_decision <> '' AND score > 150) AS decisive_rows FROM {work} GROUP BY 1)
    SELECT review_reason, rows, decisive_rows, CASE review_reason WHEN 'error' THEN 'high' WHEN 'view' THEN 'medium' WHEN 'click' THEN 'medium' ELSE 'normal' END AS priority, least(rows, CASE WHEN review_reason IN ('view', 'click') THEN 3 ELSE 5 END) AS target_decisive_rows,
      greatest(0, least(rows, CASE WHEN review_reason IN ('view', 'click') THEN 3 ELSE 5 END) - decisive_rows) AS decisive_rows_needed, CASE review_reason WHEN 'view' THEN 'spot_check_candidate' WHEN 'click' THEN 'keep_review_lane' ELSE 'needs_more_labels' END AS recommendation FROM l"""
)
def a30_label_targets(spark, d):
    lanes = load(spark, d, "work").groupBy("review_reason").agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col("manual_decision") != "") & (F.col("score") > 150)).alias("decisive_rows")).withColumn("recommendation", F.lit(""))
    return calibration.label_targets(lanes, ["error"], ["view"], ["click"])


@query(
    """SELECT seq, CASE WHEN manual_decision = '' THEN 'unlabeled' WHEN seq % 2 = 0 THEN CASE WHEN manual_decision = 'accept' THEN 'holdout_blocked' ELSE 'holdout_supported' END WHEN manual_decision = 'accept' THEN 'release_supported' ELSE 'release_blocked' END AS outcome FROM {work}"""
)
def a19_policy_outcome(spark, d):
    action = F.when(F.col("seq") % 2 == 0, "Holdout").otherwise("release")
    return load(spark, d, "work").select("seq", calibration.policy_outcome(F.col("manual_decision"), action, F.col("manual_url"), F.lit("")).alias("outcome"))


@query(
    """WITH t AS (SELECT pos, concat_ws('; ', CASE WHEN pos % 5 = 0 THEN 'wrong_candidate_no_replacement' END, CASE WHEN pos % 5 = 0 THEN 'confirmed_no_official' END, CASE WHEN pos % 5 = 1 THEN 'candidate_unreachable' END, CASE WHEN pos % 5 = 2 THEN 'wrong_company' END, CASE WHEN source = 'brave' THEN 'insufficient_evidence' END) AS tags FROM {candidates}) SELECT tags, count(*) AS n FROM t GROUP BY 1"""
)
def t22_note_tags(spark, d):
    c = load(spark, d, "candidates")
    notes = F.when(F.col("pos") % 5 == 0, "No official site").when(F.col("pos") % 5 == 1, "打不开").when(F.col("pos") % 5 == 2, "同名").otherwise("")
    tags = calibration.note_tags(notes, F.col("url"), F.lit(""), F.when(F.col("source") == "brave", "unsure").otherwise(""), F.lit(None).cast("string"))
    return c.select(F.array_join(tags, "; ").alias("tags")).groupBy("tags").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_FINAL}, c AS (SELECT provider_id, max_by(url, struct_pack(a := score, b := -pos)) AS u FROM {{candidates}} GROUP BY 1), t AS (SELECT f.*, coalesce(nullif(official_url, ''), c.u, '') AS cand, official_url <> '' AND status IN ('matched', 'manual_accepted') AS ok, coalesce(TRY_CAST(nullif(confidence, '') AS INT), 0) AS n FROM final_rows f LEFT JOIN c ON f.provider_id = c.provider_id),
    r AS (SELECT provider_id, CASE WHEN ok THEN 'precision_same_name_risk' WHEN cand <> '' AND cand NOT LIKE '%facebook.com%' AND cand NOT LIKE '%linkedin.com%' THEN 'recall_unresolved_candidate' END AS visual_reason FROM t) SELECT * FROM r WHERE visual_reason IS NOT NULL"""
)
def r5_visual_lane(spark, d):
    best = load(spark, d, "candidates").groupBy("provider_id").agg(F.max_by("url", F.struct("score", (-F.col("pos")).alias("p"))).alias("candidate_url"))
    named = load(spark, d, "results").select("provider_id", F.regexp_replace("provider_name", "#.*$", "").alias("provider_name"))
    rows = _final(spark, d).drop("provider_name").join(named, "provider_id").join(best, "provider_id", "left")
    return secondpass.visual_lane(rows, EXCLUDED_DOMAINS).select("provider_id", "visual_reason")


@query(
    r"""SELECT page_id, regexp_matches(regexp_extract(lower(url), '^https?://([^/?#]*)', 1), '(zendesk[.]|hubspotpagebuilder[.]|myshopify[.]com|app[.]|apps[.]|staging[.]|develop[.]|onboarding[.]|refund[.])') OR regexp_matches(lower(url), '^https?://[^/?#]*[^#]*(domain_profile|/name/|suspendedpage|/login|/password|/signin|/sign-in)') AS risky FROM {pages}"""
)
def g14_risky_address(spark, d):
    return load(spark, d, "pages").select("page_id", secondpass.risky_address(F.col("url")).alias("risky"))


@query(
    """WITH p AS (SELECT provider_id, regexp_replace(lower(provider_name), '[^a-z0-9]+', '', 'g') AS s, string_split(trim(regexp_replace(lower(provider_name), '[^a-z0-9]+', ' ', 'g')), ' ') AS w, CASE location WHEN 'Germany' THEN ['de'] WHEN 'United Kingdom' THEN ['co.uk', 'uk'] WHEN 'Ukraine' THEN ['co.uk', 'uk'] WHEN 'France' THEN ['fr'] WHEN 'Poland' THEN ['pl'] ELSE CAST([] AS VARCHAR[]) END AS t FROM {providers}),
    v AS (SELECT provider_id, list_concat(t, list_filter(['com', 'co', 'io', 'net'], lambda x: NOT list_contains(t, x))) AS t, CASE WHEN s = w[1] || w[2] THEN [s] ELSE [s, w[1] || w[2]] END AS l FROM p)
    SELECT provider_id, count(*) AS n FROM (SELECT provider_id, unnest(l) AS s, t FROM v), unnest(t) AS u(x) GROUP BY 1"""
)
def c11_domain_variants(spark, d):
    return seeds.domain_variants(_providers(spark, d), EXCLUDED_DOMAINS).groupBy("provider_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH p AS (SELECT provider_id, regexp_replace(lower(provider_name), '[^a-z0-9]+', '', 'g') AS s, string_split(trim(regexp_replace(lower(provider_name), '[^a-z0-9]+', ' ', 'g')), ' ') AS w, CASE location WHEN 'Germany' THEN ['de'] WHEN 'United Kingdom' THEN ['co.uk', 'uk'] WHEN 'Ukraine' THEN ['co.uk', 'uk'] WHEN 'France' THEN ['fr'] WHEN 'Poland' THEN ['pl'] ELSE CAST([] AS VARCHAR[]) END AS t, pos FROM {providers}),
    v AS (SELECT provider_id, pos, list_concat(t, list_filter(['com', 'co', 'io', 'net'], lambda x: NOT list_contains(t, x))) AS t, CASE WHEN s = w[1] || w[2] THEN [s] ELSE [s, w[1] || w[2]] END AS l FROM p),
    d AS (SELECT provider_id, unnest(flatten(list_transform(l, lambda s: list_transform(t, lambda x: 'https://www.' || s || '.' || x)))) AS url, unnest(range(0, len(l) * len(t))) AS k FROM v),
    e AS (SELECT provider_id, 'https://top' || (pos % 5) || '.com' AS url, 'second_pass_top_candidate' AS source, 0 AS a, 0 AS k FROM p WHERE pos % 4 <> 0 AND pos % 4 <> 1
      UNION ALL SELECT provider_id, 'https://www.shop' || (pos % 5) || '.de', 'second_pass_input_url', 1, 0 FROM p UNION ALL SELECT provider_id, 'https://top' || (pos % 3) || '.com', 'second_pass_input_url', 1, 1 FROM p UNION ALL SELECT provider_id, url, 'second_pass_domain_variant', 2, k FROM d),
    f AS (SELECT *, row_number() OVER (PARTITION BY provider_id, url ORDER BY a, k) AS r FROM e) SELECT provider_id, url, source, CASE WHEN a = 2 THEN 0 ELSE CAST(k + 1 AS INT) END AS rank FROM f WHERE r = 1"""
)
def c11_seed_candidates(spark, d):
    planned = _providers(spark, d).withColumns(
        {
            "top_candidate_url": F.expr("CASE WHEN pos % 4 = 0 THEN '' WHEN pos % 4 = 1 THEN 'https://www.linkedin.com/x' ELSE 'https://top' || (pos % 5) || '.com' END"),
            "about_listing_text": F.expr("'See www.shop' || (pos % 5) || '.de, or'"),
            "service_description": F.expr("'top' || (pos % 3) || '.com; facebook.com/x'"),
        }
    )
    return seeds.seed_candidates(planned, ["about_listing_text", "service_description"], EXCLUDED_DOMAINS).select("provider_id", "url", "source", "rank")


@query(
    """WITH q AS (SELECT provider_id, ['official company website for "' || provider_name || '" Amazon seller service provider ' || location, '"' || provider_name || '" ecommerce agency marketplace services official site contact ' || location, '"' || provider_name || '" Amazon Seller Central marketplace agency official website contact'] AS l FROM {providers})
    SELECT provider_id, CAST(k AS INTEGER) AS query_pos, l[k + 1] AS query FROM q, generate_series(0, 2) AS t(k)"""
)
def c12_semantic_queries(spark, d):
    made = seeds.semantic_queries(F.col("provider_name"), F.col("location"), F.col("segment"))
    return load(spark, d, "providers").select("provider_id", F.posexplode(made).alias("query_pos", "query"))


@query(
    """WITH b AS (SELECT provider_id, max_by(struct_pack(u := url, s := score, r := reject), struct_pack(a := score, b := -pos)) AS b, count(DISTINCT source) FILTER (source IN ('brave', 'serper') AND url LIKE 'http://site%') AS k FROM {candidates} GROUP BY 1)
    SELECT provider_id, NOT b.r AND b.s >= 75 AND (b.s >= 85 OR (SELECT count(DISTINCT source) FROM {candidates} WHERE candidates.provider_id = b.provider_id AND source <> 'domain_guess' AND regexp_replace(regexp_replace(lower(url), '^https?://(www[.])?', ''), '/.*$', '') = regexp_replace(regexp_replace(lower(b.b.u), '^https?://(www[.])?', ''), '/.*$', '')) >= 2) AS accepted FROM b"""
)
def g13_accepted(spark, d):
    found = load(spark, d, "candidates").withColumn("reasons", F.array(F.lit("top_search_result")))
    best = found.groupBy("provider_id").agg(F.max_by(F.struct("url", "score"), F.struct("score", (-F.col("pos")).alias("p"))).alias("b"), F.collect_list(F.struct("url", "source", "reasons", "reject")).alias("candidates"))
    rows = best.select("provider_id", "candidates", F.col("b.url").alias("official_url"), F.col("b.score").alias("confidence"), F.when(F.col("b.score") >= 75, "matched").when(F.col("b.score") >= 45, "needs_review").otherwise("low_confidence").alias("status"), F.lit("").alias("evidence_summary"))
    return seeds.accepted(rows, EXCLUDED_DOMAINS).select("provider_id", "accepted")


# ---- verification ---------------------------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_PROFILES = "(VALUES " + ", ".join(f"({k}, {_list(geo._plain(n) for n in names)}, {_list([*official[:3], *service[:2]])})" for k, (_, names, _, official, service) in enumerate(COUNTRIES)) + ") AS profiles(k, names, terms)"


@query(
    f"""WITH p AS (SELECT provider_id, provider_name, location, lower(location) AS said FROM {{providers}}),
    m AS (SELECT provider_id, k, unnest(terms) AS term, unnest(generate_series(1, len(terms))) AS j FROM p, {_PROFILES} WHERE len(list_filter(names, lambda n: contains(said, n))) > 0),
    o AS (SELECT provider_id, term, row_number() OVER (PARTITION BY provider_id ORDER BY min(k * 100 + j)) AS nth FROM m GROUP BY provider_id, term),
    q AS (SELECT provider_id, 0 AS query_pos, '"' || provider_name || '" official website' AS query FROM p UNION ALL SELECT provider_id, 1, '"' || provider_name || '" contact' FROM p
          UNION ALL SELECT provider_id, 2, '"' || provider_name || '" "' || location || '"' FROM p UNION ALL SELECT provider_id, 2 + nth, '"' || provider_name || '" "' || term || '"' FROM p JOIN o USING (provider_id) WHERE nth <= 4)
    SELECT provider_id, CAST(query_pos AS INTEGER) AS query_pos, query FROM q"""
)
def c13_independent_queries(spark, d):
    made = verification.independent_queries(F.col("provider_name"), F.array("location"))
    return load(spark, d, "providers").select("provider_id", F.posexplode(made).alias("query_pos", "query"))


@query()
def g18_g19_g22_verification(spark, d):
    hosts = _hosts(spark, d)
    done = verification.verify_sites(_found_sites(hosts), pages.read_pages(hosts))
    return done.select("provider_id", "domain", "score", verification.needs_search(F.col("url"), F.col("score"), F.col("counter_evidence")).alias("search_again"), *[F.array_join(c, "; ").alias(c) for c in ("evidence_urls", "supporting_facts", "counter_evidence")])


@query(
    r"""WITH c AS (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY pos) AS nth FROM {candidates}),
    r AS (SELECT c.*, r.official_url FROM c JOIN (SELECT * FROM {results}) r USING (provider_id) WHERE nth <= 12 AND NOT reject AND c.score >= 40),
    o AS (SELECT * FROM r WHERE regexp_replace(regexp_replace(lower(url), '^https?://(www[.])?', ''), '/.*$', '') <> regexp_replace(regexp_replace(regexp_replace(lower(official_url), '^https?://', ''), '^www[.]', ''), '/.*$', ''))
    SELECT provider_id, arg_max(url, CAST(score AS BIGINT) * 1000000000 - pos) AS replacement_url, max(score) AS replacement_score FROM o GROUP BY provider_id"""
)
def g20_best_replacement(spark, d):
    current = load(spark, d, "results").select("provider_id", F.col("official_url").alias("current_url"))
    return verification.best_replacement(load(spark, d, "candidates"), current, least=40)


# ---- review work, labels and features -------------------------------------------------------

_APPLIED = """f AS (SELECT *, CASE WHEN manual_url ILIKE '%HYPERLINK(%' THEN regexp_extract(manual_url, '"([^"]+)"', 1) ELSE manual_url END AS u, CASE lower(trim(manual_decision)) WHEN 'yes' THEN 'accept' WHEN 'override' THEN 'replace' WHEN 'no' THEN 'reject' ELSE lower(trim(manual_decision)) END AS w FROM {filled}),
    applied AS (SELECT * EXCLUDE (manual_decision, manual_url, w, u), u AS manual_url, CASE WHEN u <> '' AND w IN ('reject', '') THEN 'replace' ELSE w END AS manual_decision FROM f)""".replace("\\\\", "\\")


@query(f"WITH {_APPLIED} SELECT pos, manual_decision, manual_url, manual_decision NOT IN ('unsure', '') AS applied FROM applied")
def j10_filled_rows(spark, d):
    return learning.normalize_filled(load(spark, d, "filled")).select("pos", "manual_decision", "manual_url", "applied")


@query(
    f"""WITH {_APPLIED}, l AS (SELECT *, coalesce(nullif(manual_url, ''), official_url) AS x FROM applied WHERE manual_decision IN ('accept', 'replace'))
    SELECT provider_id, CASE WHEN contains(x, '://') THEN x ELSE 'https://' || x END AS expected_url, regexp_replace(regexp_replace(regexp_replace(x, '^https?://', ''), '^www[.]', ''), '/.*$', '') AS expected_domain FROM l WHERE x <> ''"""
)
def j9_manual_labels(spark, d):
    rows = learning.normalize_filled(load(spark, d, "filled"))
    return learning.manual_labels(rows.filter("applied")).select("provider_id", "expected_url", "expected_domain")


@query(
    """WITH l AS (SELECT l.*, o.provider_id IS NOT NULL AS found, o.status, CASE WHEN official_url LIKE 'https://elsewhere%' THEN 'elsewhere.org' ELSE regexp_extract(official_url, '^https://www[.]([^/]*)', 1) END AS actual FROM (SELECT * FROM {entity_labels}) l LEFT JOIN (SELECT * REPLACE (CASE WHEN pos % 5 = 0 THEN 'x' || provider_id ELSE provider_id END AS provider_id) FROM {entity_output}) o ON l.provider_id = o.provider_id),
    c AS (SELECT count(*) AS labeled_rows, count(*) FILTER (found) AS evaluated_rows, count(*) FILTER (NOT found) AS missing_labeled_rows, count(*) FILTER (found AND expected_domain <> '' AND expected_domain = actual) AS domain_matches, count(*) FILTER (status = 'matched') AS auto_matched_rows,
      count(*) FILTER (status = 'matched' AND expected_domain <> '' AND expected_domain = actual) AS ok, count(*) FILTER (status = 'needs_review') AS needs_review_rows, count(*) FILTER (found AND actual = '') AS unresolved_rows FROM l)
    SELECT * EXCLUDE (ok), round(domain_matches / nullif(evaluated_rows, 0), 4) AS domain_accuracy, round(ok / nullif(auto_matched_rows, 0), 4) AS auto_match_precision FROM c"""
)
def a2_labeled_evaluation(spark, d):
    labels = load(spark, d, "entity_labels").withColumn("expected_url", F.lit(""))
    return learning.evaluation_summary(learning.evaluated(labels, load(spark, d, "entity_output").withColumn("provider_id", _unknown("pos % 5 = 0"))))


# an address cell as labels compare it: HYPERLINK cells unwrapped, closing punctuation and what follows the path dropped
_CELL = r"regexp_replace(regexp_replace(CASE WHEN {c} ILIKE '%HYPERLINK(%' THEN regexp_extract({c}, '\"([^\"]+)\"', 1) WHEN {c} = '' OR {c} LIKE 'http%' THEN {c} ELSE 'https://' || {c} END, '[.,);]+$', ''), '(;[^/]*|/+)$', '')"


@query(
    rf"""WITH v AS (SELECT provider_id, max_by(struct_pack(w := CASE lower(trim(manual_decision)) WHEN 'yes' THEN 'accept' WHEN 'override' THEN 'replace' WHEN 'no' THEN 'reject' ELSE lower(trim(manual_decision)) END,
      g := {_CELL.replace("{c}", "manual_url")}, s := coalesce(nullif({_CELL.replace("{c}", "official_url")}, ''), {_CELL.replace("{c}", "current_or_candidate_url")})), pos) AS r FROM {{filled}} GROUP BY 1),
    b AS (SELECT r.provider_id, coalesce(v.r.w, '') AS w, coalesce(v.r.g, '') AS g, coalesce(v.r.s, '') AS s, {_CELL.replace("{c}", "official_url")} AS o FROM (SELECT * FROM {{results}}) r LEFT JOIN v ON r.provider_id = v.provider_id),
    x AS (SELECT *, CASE WHEN w IN ('replace', 'reject') THEN g WHEN w = 'accept' THEN coalesce(nullif(g, ''), s) ELSE o END AS u FROM b WHERE w <> 'unsure')
    SELECT provider_id, CASE w WHEN 'replace' THEN CASE WHEN u <> '' THEN 'human_replace' ELSE 'human_replace_missing_url' END WHEN 'reject' THEN CASE WHEN u <> '' THEN 'human_reject_with_url' ELSE 'human_reject' END WHEN 'accept' THEN CASE WHEN u <> '' THEN 'human_accept' ELSE 'human_accept_no_url' END
      ELSE CASE WHEN u <> '' THEN 'baseline_unmarked_correct' ELSE 'baseline_unmarked_no_official' END END AS label_source, CASE WHEN u <> '' THEN 'official' ELSE 'no_official' END AS expected_kind, u AS expected_url,
      lower(regexp_replace(regexp_replace(regexp_replace(u, '^https?://', ''), '^www[.]', ''), '/.*$', '')) AS expected_domain FROM x"""
)
def a5_labels_from_review(spark, d):
    return learning.labels_from_review(load(spark, d, "results"), load(spark, d, "filled")).drop("provider_name")


@query(
    """SELECT t.pos AS task_pos, t.provider_id, coalesce(nullif(t.official_url, ''), f.official_url) AS official_url, f.status, f.confidence FROM (SELECT * FROM {filled}) t LEFT JOIN (SELECT * REPLACE (CASE WHEN pos % 3 = 0 THEN 'x' || provider_id ELSE provider_id END AS provider_id, CASE WHEN pos % 3 = 0 THEN 'x' ELSE '' END || provider_name AS provider_name) FROM {results}) f ON t.provider_id = f.provider_id"""
)
def j12_verification_input(spark, d):
    task = load(spark, d, "filled").select("provider_id", "provider_name", F.col("pos").alias("task_pos"), "official_url")
    return learning.verification_input(load(spark, d, "results").withColumns({"provider_id": _unknown("pos % 3 = 0"), "provider_name": _unknown("pos % 3 = 0", "provider_name")}), task).select("task_pos", "provider_id", "official_url", "status", "confidence")


@query(
    """SELECT c.pos, NOT (r.status = 'matched' AND coalesce(TRY_CAST(r.confidence AS INT), 0) >= 83 AND contains(r.official_url, 'www.') AND NOT contains(c.counter_evidence, 'provider_name_not_found') AND NOT contains(c.candidate_url, 'linkedin.com') AND c.decision <> 'accept')
      AS high_risk FROM (SELECT * FROM {checks}) c JOIN (SELECT * FROM {results}) r ON c.provider_id = r.provider_id WHERE r.status = 'matched'"""
)
def r4_high_risk(spark, d):
    r = load(spark, d, "results").filter("status = 'matched'").select("provider_id", "status", "confidence", "official_url")
    rows = load(spark, d, "checks").join(r, "provider_id")
    risky = learning.high_risk(F.col("status"), F.col("confidence"), F.col("counter_evidence"), F.col("official_url"), F.col("candidate_url"), F.col("provider_name"), F.col("decision") == "accept")
    return rows.select("pos", risky.alias("high_risk"))


def _features_sql() -> str:
    has = "list_filter(list_transform(string_split({c}, ';'), lambda x: regexp_replace(trim(x), '\\s+', '_', 'g')), lambda x: x <> '')"
    bounds = "[" + ", ".join(f"CASE WHEN score >= {t} THEN 'agent_b_score>={t}' ELSE 'agent_b_score<{t}' END" for t in learning.SCORE_BOUNDS) + "]"
    named = "[" + ", ".join(f"CASE WHEN contains(lower(provider_name), '{m}') THEN 'provider_name_contains:{m}' END" for m in learning.NAME_MARKERS) + "]"
    return f"""c AS (SELECT *, CAST(evidence_score AS INT) AS score, {has.format(c="supporting_facts")} AS facts, {has.format(c="counter_evidence")} AS counters, trim(regexp_replace(lower(provider_name), '[^a-z0-9]+', ' ', 'g')) AS norm,
        regexp_extract(candidate_url, '^https://www[.]([^/]*)', 1) AS candidate_domain FROM {{checks}}),
    w AS (SELECT *, list_filter(string_split(norm, ' '), lambda x: length(x) >= 3) AS words, replace(norm, ' ', '') AS own, string_split(candidate_domain, '.')[1] AS other FROM c),
    x AS (SELECT *, len(list_filter(words, lambda x: contains(other, x))) AS shared FROM w),
    features AS (SELECT x.* EXCLUDE (words), list_sort(list_distinct(list_filter(list_concat({bounds}, {named}, list_transform(facts, lambda f: 'has:' || f), list_transform(counters, lambda f: 'counter:' || f),
        list_transform(list_filter({_list(learning.IDENTITY_FACTS)}, lambda m: len(list_filter(facts, lambda f: f = m OR starts_with(f, m || ':'))) = 0), lambda m: 'missing:' || m),
        [CASE WHEN review_reason <> '' THEN 'review_reason:' || review_reason END, 'agent_b_decision:' || decision, CASE WHEN reason_for_unsure <> '' THEN 'reason_for_unsure:' || reason_for_unsure END, CASE WHEN len(list_filter(facts, lambda f: starts_with(f, 'location_matches:'))) > 0 THEN 'has:location_matches' END,
         'provider_token_count:' || least(len(words), 5), CASE WHEN len(words) = 1 THEN 'provider_name_shape:single_token' END, CASE WHEN len(list_filter(words, lambda w: NOT list_contains({_list(learning.GENERIC_TOKENS)}, w))) <= 1 THEN 'provider_name_shape:generic_or_one_meaningful_token' END,
         CASE WHEN length(array_to_string(words, '')) <= 4 THEN 'provider_name_shape:short' END, CASE WHEN other = '' THEN NULL WHEN own = other THEN 'domain_relation:exact_provider_slug' WHEN contains(other, own) THEN 'domain_relation:domain_contains_provider_slug' WHEN contains(own, other) THEN 'domain_relation:provider_slug_contains_domain' END,
         CASE WHEN other <> '' AND shared >= 1 THEN 'domain_relation:provider_token_in_domain' END, CASE WHEN other <> '' AND shared >= 2 THEN 'domain_relation:two_provider_tokens_in_domain' END]), lambda f: f IS NOT NULL))) AS features FROM x)"""


@query(f"WITH {_features_sql()} SELECT pos, array_to_string(features, '|') AS features FROM features")
def p1_evidence_features(spark, d):
    c = F.col
    made = learning.evidence_features(c("provider_name"), c("review_reason"), c("decision"), c("reason_for_unsure"), text.whole_number(c("evidence_score")), c("supporting_facts"), c("counter_evidence"), urls.domain(c("candidate_url")))
    return load(spark, d, "checks").select("pos", F.array_join(made, "|").alias("features"))


@query(
    f"""WITH {_DETAILS}, {_features_sql()}, k AS (SELECT provider_id, max(pos) AS pos FROM {{checks}} GROUP BY 1), j AS (SELECT d.*, f.* EXCLUDE (provider_id, review_reason), f.review_reason AS lane FROM details d JOIN k ON d.provider_id = k.provider_id JOIN features f ON f.pos = k.pos)
    SELECT provider_id, 'recall' AS scope, expected_kind = 'official' AND candidate_domain = expected_domain AS correct, candidate_domain, array_to_string(features, '|') AS features FROM j WHERE lane = 'recall_unresolved_top_candidate' AND candidate_domain <> ''
    UNION ALL SELECT provider_id, 'precision', outcome = 'correct_official', candidate_domain, array_to_string(features, '|') FROM j WHERE starts_with(lane, 'precision_') AND candidate_domain <> ''"""
)
def p2_labeled_pattern_rows(spark, d):
    details, checks = _details(spark, d).drop("review_reason").withColumn("output_domain", F.lit("")), load(spark, d, "checks")
    both = [learning.labeled_pattern_rows(details, checks, s) for s in ("recall", "precision")]
    return both[0].unionByName(both[1]).select("provider_id", "scope", "correct", "candidate_domain", F.array_join("features", "|").alias("features"))


_BLOB = "lower(concat_ws(' ', supporting_facts, counter_evidence, reason_for_unsure))"


@query(
    rf"""WITH x AS (SELECT *, {_BLOB} AS b, regexp_extract_all(lower(provider_name), '[a-z0-9]+') AS w FROM {{checks}}),
    y AS (SELECT *, len(w) <= 2 OR len(list_filter(w, lambda t: list_contains({_sql_list(recommend.SHARED_WORDS)}, t))) >= 2 AS vague FROM x),
    z AS (SELECT pos, review_reason, CASE WHEN contains(b, 'provider_name_not_found_on_candidate_pages') THEN 'missing_provider_name_boundary' WHEN review_reason = 'precision_slug_extension_identity_risk' THEN CASE WHEN decision = 'accept' THEN 'slug_extension_agentb_accept' WHEN vague THEN 'slug_extension_generic_identity' ELSE 'slug_extension_identity_boundary' END
      WHEN review_reason = 'recall_unresolved_top_candidate' THEN 'recall_unresolved_candidate_boundary' WHEN review_reason = 'precision_low_confidence_auto_match' THEN 'low_confidence_auto_match_boundary' WHEN starts_with(review_reason, 'precision_generic') THEN CASE WHEN vague THEN 'generic_short_name_collision' ELSE 'generic_identity_boundary' END ELSE 'protected_lane_boundary' END AS priority_reason FROM y)
    SELECT pos, priority_reason, CASE WHEN review_reason = 'recall_unresolved_top_candidate' THEN 'recall_rule' WHEN contains(priority_reason, 'missing') THEN 'service_evidence_for_name' WHEN contains(priority_reason, 'slug_ext') THEN 'slug_extension' WHEN contains(priority_reason, 'generic') THEN 'generic_names' ELSE 'none_alone' END AS decision_impact FROM z"""
)
def r10_priority_reason(spark, d):
    rows = load(spark, d, "checks").withColumnRenamed("decision", "agent_b_decision")
    return recommend.priority_reason(rows).select("pos", "priority_reason", "decision_impact")


@query(
    """SELECT pos FROM {checks} WHERE review_reason <> '' OR contains(counter_evidence, 'directory') OR contains(counter_evidence, 'identity') OR (contains(supporting_facts, 'logo') AND NOT contains(supporting_facts, 'page_contains_exact_provider_name')) OR CAST(evidence_score AS INT) < 83 OR CAST(evidence_score AS INT) < 75"""
)
def r6_judge_queue(spark, d):
    return recommend.judge_queue(load(spark, d, "checks").withColumn("confidence", F.col("evidence_score"))).select("pos")


@query(
    """WITH p AS (SELECT CASE WHEN segment = 'MACHINERY' THEN 'x' || provider_id ELSE provider_id END AS provider_id, CASE WHEN pos % 3 = 0 THEN '' ELSE 'https://d.org/' || pos END AS detail_url, CASE WHEN pos % 4 = 0 THEN ' ' ELSE 'l' || pos END AS logo FROM {providers}),
    j AS (SELECT r.provider_id, coalesce(nullif(p.detail_url, ''), CASE WHEN r.pos % 5 = 0 THEN 'https://own.org' ELSE '' END) AS provider_detail_url, trim(coalesce(p.logo, '')) AS listing_logo_url FROM (SELECT * FROM {results}) r LEFT JOIN p ON r.provider_id = p.provider_id)
    SELECT count(*) AS input_rows, count(*) FILTER (provider_detail_url <> '') AS provider_detail_url_rows, count(*) FILTER (provider_detail_url = '') AS missing_provider_detail_url_rows, count(*) FILTER (listing_logo_url <> '') AS listing_logo_rows FROM j"""
)
def j4_link_counts(spark, d):
    own = load(spark, d, "providers").withColumns({"provider_id": _unknown("segment = 'MACHINERY'"), "provider_name": F.lit("nobody"), "detail_url": F.expr("CASE WHEN pos % 3 = 0 THEN '' ELSE 'https://d.org/' || pos END"), "listing_logo_url": F.expr("CASE WHEN pos % 4 = 0 THEN ' ' ELSE 'l' || pos END")})
    rows = load(spark, d, "results").withColumn("detail_url", F.expr("CASE WHEN pos % 5 = 0 THEN 'https://own.org' ELSE '' END"))
    return providers.link_counts(providers.enrich_links(rows, own))


@query("SELECT w.seq FROM (SELECT * FROM {work}) w WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {work}) f WHERE f.manual_decision <> '' AND f.score > 60 AND f.provider_id = w.provider_id AND f.review_reason = w.review_reason)")
def j13_unfilled_keys(spark, d):
    work = load(spark, d, "work").withColumn("provider_name", F.lit(""))
    return review.unfilled(work, work.filter("score > 60"), by_reason=True).select("seq")


@query(
    """SELECT pos, CASE pos % 6 WHEN 0 THEN 'accept' WHEN 1 THEN '' WHEN 2 THEN 'reject' WHEN 3 THEN 'unsure' ELSE '' END AS decision, CASE WHEN pos % 6 IN (1, 5) THEN 'invalid_manual_decision' ELSE '' END AS issue FROM {filled}"""
)
def t21_sample_decisions(spark, d):
    rows = load(spark, d, "filled")
    return rows.select("pos", recommend.sample_decision(F.col("manual_decision")).alias("decision"), recommend.quality_issue(F.col("manual_decision"), F.col("manual_url")).alias("issue"))


@query("WITH r AS (" + ORACLES["a17_pattern_recommendations"] + ") SELECT pattern, recommendation, CASE recommendation WHEN 'candidate_for_rule' THEN 'test_then_narrow_recall_rule' WHEN 'needs_more_labels' THEN 'keep_in_samples' ELSE 'keep_in_review' END AS required_action, row_number() OVER (PARTITION BY recommendation ORDER BY supporting_rows DESC, decisive_rows DESC, pattern) AS place FROM r WHERE recommendation <> 'unlabeled'")
def a17_rule_buckets(spark, d):
    rows = recommend.rule_buckets(a17_pattern_recommendations(spark, d))
    return rows.select("pattern", "recommendation", "required_action", F.row_number().over(Window.partitionBy("recommendation").orderBy("rank")).cast("long").alias("place"))


@query(
    """WITH r AS (SELECT f.*, s.status, s.confidence, s.official_url AS shown FROM (SELECT * FROM {filled}) f JOIN (SELECT * FROM {results}) s ON f.provider_id = s.provider_id),
    x AS (SELECT CASE pos % 6 WHEN 0 THEN 'accept' WHEN 1 THEN 'replace' WHEN 2 THEN 'reject' ELSE 'unsure' END AS d, shown, CASE WHEN pos % 6 < 2 THEN manual_url ELSE '' END AS u, status, pos, coalesce(TRY_CAST(confidence AS INT), 0) AS n FROM r)
    SELECT count(*) FILTER (d = 'accept') AS accept_rows, count(*) FILTER (d = 'replace') AS replace_rows, count(*) FILTER (d = 'reject') AS reject_rows, count(*) FILTER (d = 'unsure') AS unsure_rows, count(*) FILTER (d IN ('accept', 'replace') AND (u <> '' OR shown <> '') AND n > 0 AND n < 70) AS accepted_low_confidence_rows,
      count(*) FILTER (d IN ('accept', 'replace') AND u <> '' AND shown = '') AS recall_additions, count(*) FILTER (d = 'reject' AND shown <> '' AND pos % 5 = 0) AS rejected_auto_accepted_rows, count(*) FILTER (pos % 7 = 0) AS confirmed_no_official_rows, count(*) FILTER (pos % 7 = 0 AND shown <> '') AS wrong_candidate_no_official_rows FROM x"""
)
def a20_learning_summary(spark, d):
    shown = load(spark, d, "results").select("provider_id", F.col("status").alias("previous_status"), "confidence", F.col("official_url").alias("previous_url"))
    rows = load(spark, d, "filled").drop("official_url").join(shown, "provider_id").withColumns(
        {
            "manual_decision": F.expr("CASE pos % 6 WHEN 0 THEN 'accept' WHEN 1 THEN 'replace' WHEN 2 THEN 'reject' ELSE 'unsure' END"),
            "manual_url": F.when(F.col("pos") % 6 < 2, text.cell_url(F.col("manual_url"))).otherwise(""),
            "previously_decided": F.col("pos") % 5 == 0,
            "error_type": F.lit(""),
            "notes": F.when(F.col("pos") % 7 == 0, "No official site").otherwise(""),
        }
    )
    return recommend.learning_summary(rows)


@query(
    """WITH b AS (SELECT CAST(user_id AS STRING) || CASE WHEN user_id % 3 = 0 THEN '_balance_tuned' ELSE '_full' END AS run_dir, count(*) AS released_rows, count(*) FILTER (event_type = 'error') AS unresolved_rows, max(value) > 90 AS ok FROM {events} GROUP BY user_id)
    SELECT count(*) AS batches, CAST(sum(released_rows) AS BIGINT) AS released_rows, CAST(sum(released_rows) AS BIGINT) AS official_url_rows, CAST(sum(unresolved_rows) AS BIGINT) AS unresolved_rows, count(*) FILTER (NOT ok) AS quality_blockers, CAST(sum(released_rows) FILTER (NOT (contains(run_dir, '100') OR contains(run_dir, 'tuned'))) AS BIGINT) AS unlabelled_released_rows FROM b"""
)
def a29_batch_rollup(spark, d):
    runs = load(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("released_rows"), F.count_if(F.col("event_type") == "error").alias("unresolved_rows"), (F.max("value") > 90).alias("quality_passed"))
    return recommend.batch_rollup(runs.withColumns({"run_dir": F.concat(F.col("user_id").cast("string"), F.when(F.col("user_id") % 3 == 0, "_balance_tuned").otherwise("_full")), "official_url_rows": F.col("released_rows")}))


@query(
    f"""WITH {_SAMPLE} SELECT pos, CASE WHEN calibration_outcome LIKE 'recall%' THEN CASE WHEN contains(calibration_outcome, 'not_useful') THEN 'recall_blocking_fixture' ELSE 'recall_positive_fixture' END WHEN calibration_outcome = 'candidate_correct' THEN 'precision_positive_fixture' ELSE 'precision_blocking_fixture' END AS case_type,
      CASE WHEN pos % 9 = 0 THEN 'https://fixed.org' WHEN calibration_outcome IN ('candidate_correct', 'recall_candidate_useful') THEN CASE WHEN pos % 2 = 0 THEN 'https://own.org' ELSE 'https://cand.org' END ELSE '' END AS expected_url FROM details WHERE decision_quality_issue = '' AND normalized_decision IN ('accept', 'reject')"""
)
def p12_regression_cases(spark, d):
    rows = _sample(spark, d).withColumns({"provider_id": F.col("pos").cast("string"), "normalized_manual_url": F.expr("CASE WHEN pos % 9 = 0 THEN 'https://fixed.org' ELSE '' END"), "official_url": F.expr("CASE WHEN pos % 2 = 0 THEN ' https://own.org' ELSE '' END"), "candidate_url": F.lit("https://cand.org")})
    return regression.build_cases(rows).select("pos", "case_type", "expected_url")


# tags by the notes' own words
_TAGGED = """t AS (SELECT event_id AS pos, CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS provider_id, '' AS provider_name, CASE event_type WHEN 'error' THEN 'not working' WHEN 'view' THEN 'no official' WHEN 'click' THEN 'linkedin page, timeout' WHEN 'signup' THEN 'wrong website' ELSE 'fine' END AS notes,
      CASE WHEN event_id % 4 = 0 THEN 'https://a.com' ELSE '' END AS candidate_url, CASE WHEN event_id % 8 = 0 THEN 'http://www.a.com/x' ELSE '' END AS manual_url, CASE WHEN event_id % 5 = 0 THEN 'unsure' ELSE 'accept' END AS decision FROM {events})"""
_TAG_SQL = """, g AS (SELECT pos, provider_id, list_filter([CASE WHEN notes = 'no official' AND candidate_url <> '' THEN 'wrong_candidate_no_replacement' END, CASE WHEN notes = 'no official' THEN 'confirmed_no_official' END, CASE WHEN notes = 'wrong website' THEN 'wrong_company' END, CASE WHEN notes = 'not working' OR contains(notes, 'timeout') THEN 'candidate_unreachable' END,
      CASE WHEN candidate_url <> '' AND manual_url <> '' THEN 'domain_variant_fix' END, CASE WHEN contains(notes, 'linkedin') THEN 'platform_profile_only' END, CASE WHEN decision = 'unsure' THEN 'insufficient_evidence' END], lambda x: x IS NOT NULL) AS tags FROM t),
    k AS (SELECT * FROM (VALUES ('url_reachability', ['candidate_unreachable', 'domain_variant_fix']), ('platform_profile_evidence_only', ['platform_profile_only']), ('identity_constraint', ['wrong_company', 'service_mismatch']), ('no_official_regression', ['confirmed_no_official', 'wrong_candidate_no_replacement'])) AS v(kind, want)),
    h AS (SELECT kind, pos, provider_id, len(list_intersect(tags, want)) AS hits, row_number() OVER (PARTITION BY kind ORDER BY pos) AS r FROM g, k WHERE provider_id <> '' AND len(list_intersect(tags, want)) > 0)"""


def _tagged(spark, d):
    rows = spark.sql("WITH " + _TAGGED + " SELECT * FROM t", events=load(spark, d, "events"))
    return rows.withColumn("note_tags", calibration.note_tags(F.col("notes"), F.col("candidate_url"), F.col("manual_url"), F.col("decision"), F.lit("")))


@query(f"WITH {_TAGGED}{_TAG_SQL} SELECT g.provider_id, t.candidate_url, t.manual_url, arg_min(array_to_string(tags, '; '), g.pos) AS note_tags, min(g.pos) AS pos FROM g JOIN t USING (pos) GROUP BY 1, 2, 3")
def a24_review_fixtures(spark, d):
    return recommend.review_fixtures(_tagged(spark, d)).select("provider_id", "candidate_url", "manual_url", "note_tags", "pos")


@query("SELECT DISTINCT regexp_replace(regexp_replace(lower(url), '^https?://(www[.])?', ''), '/.*$', '') AS domain, domain <> 'facebook.com' AS added FROM {candidates}")
def a24_exclusions(spark, d):
    return recommend.exclusions_to_add(load(spark, d, "candidates").select(urls.domain(F.col("url")).alias("domain")), EXCLUDED_DOMAINS)


@query(f"WITH {_TAGGED}{_TAG_SQL} SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM g) GROUP BY 1")
def a23_tag_counts(spark, d):
    return recommend.tag_counts(_tagged(spark, d))


@query(f"WITH {_TAGGED}{_TAG_SQL} SELECT kind, CAST(sum(CASE WHEN kind = 'no_official_regression' THEN 1 ELSE hits END) AS BIGINT) AS n, string_agg(provider_id, ',' ORDER BY pos) FILTER (r <= 50) AS examples FROM h GROUP BY 1")
def a23_tagged_recommendations(spark, d):
    return recommend.tagged_recommendations(_tagged(spark, d)).select("kind", "n", F.array_join("examples", ",").alias("examples"))


_POLICY = f"""{_features_sql()}, last AS (SELECT provider_id, max(pos) AS pos, arg_max(review_reason, pos) FILTER (review_reason <> '') AS reason FROM {{checks}} GROUP BY 1),
    j AS (SELECT r.provider_id, r.official_url AS own, r.status, coalesce(last.reason, '') AS reason, coalesce(c.review_reason, '') AS lane, coalesce(c.candidate_url, '') AS url, coalesce(f.features, []) AS f FROM (SELECT * FROM {{results}}) r
      LEFT JOIN last ON r.provider_id = last.provider_id LEFT JOIN (SELECT * FROM {{checks}}) c ON c.pos = last.pos LEFT JOIN features f ON f.pos = last.pos),
    p AS (SELECT *, CASE WHEN list_has_all(f, ['agent_b_decision:reject', 'counter:candidate_looks_directory_page']) THEN 'x' WHEN list_has_all(f, ['agent_b_score<30', 'has:location_matches']) THEN 'y' END AS hold,
      CASE WHEN list_has_all(f, ['agent_b_decision:accept']) THEN 'm' WHEN list_has_all(f, ['agent_b_score>=30']) THEN 'n' END AS free, regexp_replace(url, '/+$', '') AS offered FROM j),
    o AS (SELECT provider_id, 'holdout' AS action, coalesce(hold, 'review_reason:' || reason) AS pattern, CASE WHEN hold IS NOT NULL THEN 'hold_pattern' ELSE 'hold_review_reason' END AS policy_source, own AS candidate_url FROM p WHERE own <> '' AND (hold IS NOT NULL OR reason = 'precision_low_confidence_auto_match')
      UNION ALL SELECT provider_id, 'release', free, 'release_pattern', offered FROM p WHERE free IS NOT NULL AND own = '' AND status <> 'matched' AND (lane = '' OR starts_with(lane, 'recall_unresolved')) AND offered <> ''),
    rows AS (SELECT o.*, regexp_replace(regexp_replace(regexp_replace(lower(candidate_url), '^https?://', ''), '/.*$', ''), '^www[.]', '') AS candidate_domain, CASE WHEN l.expected_kind IS NULL THEN 'unlabeled' ELSE 'labeled_' || l.expected_kind END AS known_label_status, l.expected_kind IS NOT NULL AS decisive
      FROM o LEFT JOIN (SELECT * FROM {{entity_labels}}) l ON l.provider_id = o.provider_id)"""


def _policy_rows(spark, d):
    checks = load(spark, d, "checks")
    listed = lambda *p: spark.createDataFrame([(name, k, f) for k, (name, f) in enumerate(p)], "pattern string, pattern_pos int, features array<string>")
    hold = listed(("x", ["agent_b_decision:reject", "counter:candidate_looks_directory_page"]), ("y", ["agent_b_score<30", "has:location_matches"]))
    free = listed(("m", ["agent_b_decision:accept"]), ("n", ["agent_b_score>=30"]))
    made = policies.policy_rows(load(spark, d, "results"), checks.select("provider_id", "provider_name", "review_reason", "pos"), checks, ["precision_low_confidence_auto_match"], hold, free)
    labels = load(spark, d, "entity_labels").withColumns({"pos": F.lit(0), "expected_url": F.lit("")})
    return policies.with_labels(made, labels)


@query(f"WITH {_POLICY} SELECT provider_id, action, pattern, policy_source, candidate_url, candidate_domain, known_label_status, decisive FROM rows")
def r14_policy_rows(spark, d):
    return _policy_rows(spark, d).select("provider_id", "action", "pattern", "policy_source", "candidate_url", "candidate_domain", "known_label_status", "decisive")


@query(f"WITH {_POLICY} SELECT action, pattern, count(*) AS matched_rows, count(*) FILTER (NOT decisive) AS output_rows, count(*) FILTER (known_label_status = 'labeled_official') AS labeled_official, count(*) FILTER (known_label_status = 'labeled_no_official') AS labeled_no_official FROM rows GROUP BY ALL")
def r14_policy_summary(spark, d):
    return policies.policy_summary(_policy_rows(spark, d))


@query(
    """SELECT pos, CASE WHEN reason_for_unsure = 'agent_b_row_timeout' THEN 100 WHEN pos % 13 = 0 THEN 96 WHEN pos % 13 = 1 THEN 74 WHEN decision = 'reject' THEN 92 WHEN decision = 'accept' AND review_reason LIKE 'precision%' THEN 88 WHEN review_reason = 'recall_unresolved_top_candidate' THEN 80 WHEN decision = 'unsure' THEN 70
      WHEN review_reason LIKE '%slug_extension%' THEN 68 WHEN review_reason LIKE '%generic_identity%' THEN 66 WHEN review_reason LIKE '%low_confidence%' THEN 58 ELSE 40 END AS priority FROM {checks}"""
)
def r7_sample_priority(spark, d):
    kind = F.when(F.col("pos") % 13 == 0, "durable_safe").when(F.col("pos") % 13 == 1, "risky")
    made = learning.sample_priority(F.col("review_reason"), F.col("decision"), F.col("reason_for_unsure"), kind)
    return load(spark, d, "checks").select("pos", made["priority"].alias("priority"))


@query(
    """WITH t AS (SELECT review_reason, decision, count(*) AS n FROM {checks} GROUP BY 1, 2) SELECT review_reason, decision FROM t WHERE review_reason <> '' AND (decision = 'accept' OR (decision IN ('reject', 'unsure') AND n > 1))"""
)
def r12_lane_included(spark, d):
    t = load(spark, d, "checks").groupBy("review_reason", "decision").agg(F.count(F.lit(1)).alias("n"))
    kept = F.when(F.col("decision") == "accept", "needs_more_labels").otherwise("none")
    urgent = F.when(F.col("decision").isin("reject", "unsure") & (F.col("n") > 1), "high").otherwise("low")
    rows = t.select("review_reason", "decision", kept.alias("recommendation"), urgent.alias("priority"), F.lit(0).alias("decisive_rows_needed"), F.lit(0).alias("blocking_rows"))
    return learning.lane_included(rows).select("review_reason", "decision")


# ---- reports ----------------------------------------------------------------------------------


@query(
    f"""WITH {_DETAILS}, k AS (SELECT provider_id, max_by(struct_pack(d := decision, c := regexp_extract(candidate_url, '^https://www[.]([^/]*)', 1), r := regexp_extract(replacement_url, '^https://([^/]*)', 1)), pos) AS k FROM {{checks}} GROUP BY 1),
    j AS (SELECT details.*, k.k.d AS d, CASE k.k.d WHEN 'accept' THEN k.k.c WHEN 'replace' THEN k.k.r ELSE '' END AS s FROM details JOIN k USING (provider_id)),
    c AS (SELECT count(*) AS checked_rows, count(*) FILTER (d = 'accept') AS accept_rows, count(*) FILTER (d = 'replace') AS replace_rows, count(*) FILTER (d = 'reject') AS reject_rows, count(*) FILTER (d = 'unsure') AS unsure_rows, count(*) FILTER (outcome = 'false_official') AS false_official_rows,
      count(*) FILTER (outcome = 'false_official' AND d <> 'accept') AS false_official_caught_rows, count(*) FILTER (outcome = 'false_official' AND d = 'accept') AS false_official_accept_rows, count(*) FILTER (outcome = 'correct_official') AS correct_official_rows, count(*) FILTER (outcome = 'correct_official' AND d = 'accept') AS correct_official_accept_rows,
      count(*) FILTER (expected_kind = 'no_official') AS expected_no_official_rows, count(*) FILTER (expected_kind = 'no_official' AND d IN ('accept', 'replace')) AS no_official_accept_or_replace_rows, count(*) FILTER (outcome = 'over_rejected') AS over_rejected_rows,
      count(*) FILTER (outcome = 'over_rejected' AND s <> '' AND s = expected_domain) AS correct_recovery_rows, count(*) FILTER (outcome = 'over_rejected' AND s <> '' AND s <> expected_domain) AS wrong_recovery_rows, count(*) FILTER (outcome = 'over_rejected' AND s = '') AS hold_rows FROM j)
    SELECT *, round(false_official_caught_rows / nullif(false_official_rows, 0), 4) AS catch_rate, round(correct_official_accept_rows / nullif(correct_official_rows, 0), 4) AS accept_rate, round(correct_recovery_rows / nullif(over_rejected_rows, 0), 4) AS recovery_rate FROM c"""
)
def a12_verification_balance(spark, d):
    return reports.verification_balance(_details(spark, d), load(spark, d, "checks"))


@query(
    """WITH c AS (SELECT review_reason, count(*) AS rows, count(*) FILTER (decision = 'accept') AS accept_rows, count(*) FILTER (decision = 'replace') AS replace_rows, count(*) FILTER (decision = 'reject') AS reject_rows, count(*) FILTER (decision = 'unsure') AS unsure_rows, count(*) FILTER (reason_for_unsure = 'agent_b_row_timeout') AS timeout_rows FROM {checks} GROUP BY ROLLUP (review_reason))
    SELECT *, round(accept_rows / rows, 4) AS accept_rate, round(replace_rows / rows, 4) AS replace_rate, round(unsure_rows / rows, 4) AS unsure_rate, round(timeout_rows / rows, 4) AS timeout_rate FROM c"""
)
def a25_verification_summary(spark, d):
    return reports.verification_summary(load(spark, d, "checks"))


@query(
    """WITH c AS (SELECT regexp_extract(candidate_url, '^https://www[.]([^/]*)', 1) AS domain, count(*) AS rejections FROM {checks} WHERE decision = 'reject' GROUP BY 1) SELECT * FROM c WHERE domain <> '' AND (rejections >= 10 OR domain = 'linkedin.com')"""
)
def a22_rejected_domains(spark, d):
    return reports.rejected_domains(load(spark, d, "checks"), 10)


@query("SELECT trim(q) AS query, count(*) AS replacements FROM (SELECT unnest(string_split(independent_search_queries, ';')) AS q FROM {checks} WHERE decision = 'replace') WHERE trim(q) <> '' GROUP BY 1 HAVING count(*) >= 2")
def a22_replacement_queries(spark, d):
    return reports.replacement_queries(load(spark, d, "checks"))


_DOUBT = "(contains(counter_evidence, 'name') OR contains(reason_for_unsure, 'conflict') OR decision = 'unsure')"


@query(f"SELECT count(*) FILTER (decision = 'accept' AND CAST(evidence_score AS INT) < 70) AS low_score_accepts, count(*) FILTER {_DOUBT.replace('(contains', '(WHERE contains', 1)} AS name_conflicts FROM {{checks}}")
def a22_doubts(spark, d):
    return reports.doubts(load(spark, d, "checks"))


@query(
    f"""WITH c AS (SELECT regexp_extract(candidate_url, '^https://www[.]([^/]*)', 1) AS domain, count(*) AS n FROM {{checks}} WHERE decision = 'reject' GROUP BY 1), r AS (SELECT * FROM c WHERE domain <> '' AND (n >= 2 OR domain = 'linkedin.com')),
    q AS (SELECT trim(q) AS query, count(*) AS n FROM (SELECT unnest(string_split(independent_search_queries, ';')) AS q FROM {{checks}} WHERE decision = 'replace') WHERE trim(q) <> '' GROUP BY 1 HAVING count(*) >= 2),
    b AS (SELECT provider_id, pos, row_number() OVER (ORDER BY pos) AS k FROM {{checks}} WHERE {_DOUBT})
    SELECT 'excluded_domain' AS kind, domain, n, TRUE AS safe_to_apply, '' AS examples FROM r UNION ALL SELECT 'excluded_domain', 'learned.org', 1, TRUE, ''
    UNION ALL SELECT 'second_pass_query', '', CAST(sum(n) AS BIGINT), FALSE, (SELECT string_agg(query, '|' ORDER BY query) FROM (SELECT query FROM q ORDER BY query LIMIT 10)) FROM q HAVING count(*) > 0
    UNION ALL SELECT 'threshold_review', '', count(*), FALSE, '' FROM {{checks}} WHERE decision = 'accept' AND CAST(evidence_score AS INT) < 70 HAVING count(*) >= 2
    UNION ALL SELECT 'identity_constraint', '', count(*), FALSE, string_agg(provider_id, '|' ORDER BY k) FILTER (k <= 50) FROM b HAVING count(*) >= 3"""
)
def a22_recommendations(spark, d):
    learned = spark.createDataFrame([("learned.org",), ("linkedin.com",), (None,)], "domain string")
    return reports.verification_recommendations(load(spark, d, "checks"), learned).select("kind", "domain", "n", "safe_to_apply", F.array_join("examples", "|").alias("examples"))


@query(f"SELECT provider_id, candidate_url, arg_min(decision, pos) AS decision, arg_min(evidence_score, pos) AS evidence_score, 'needs_identity_review' AS expected_outcome FROM {{checks}} WHERE {_DOUBT} GROUP BY 1, 2")
def a24_identity_fixtures(spark, d):
    return reports.identity_fixtures(load(spark, d, "checks")).select("provider_id", "candidate_url", "decision", "evidence_score", "expected_outcome")


@query(
    f"""WITH {_LANES} SELECT review_reason, review_task_rows, risk_rows, CASE WHEN risk_rows > 0 THEN 'protected' WHEN labeled_rows >= 3 THEN 'spot_check' ELSE 'more_labels' END AS policy,
    CASE WHEN risk_rows > 0 THEN concat_ws('; ', CASE WHEN false_official_rows > 0 THEN 'would miss ' || false_official_rows || ' labeled false official row(s)' END, CASE WHEN over_rejected_rows > 0 THEN 'would miss ' || over_rejected_rows || ' labeled over-rejected official row(s)' END)
      WHEN labeled_rows >= 3 THEN 'labeled rows are clean so far; keep as sampled spot-check before removing' ELSE 'not enough labeled evidence to remove or keep permanently' END AS reason FROM lanes"""
)
def a26_lane_policy(spark, d):
    return reports.lane_policy(balance.review_lanes(_in_task(spark, d), load(spark, d, "entity_output").filter("review_reason is not null")))


@query(
    f"""WITH {_DETAILS}, b AS (SELECT {_SUMMARY} FROM details), c AS (SELECT {_SUMMARY} FROM (SELECT * FROM details WHERE expected_kind = 'official')), m(metric, baseline, calibrated) AS ("""
    + " UNION ALL ".join(f"SELECT '{m}', CAST(b.{m} AS DOUBLE), CAST(c.{m} AS DOUBLE) FROM b, c" for m in reports.DELTA_METRICS)
    + ") SELECT *, round(calibrated - baseline, 4) AS delta FROM m"
)
def a29_metric_deltas(spark, d):
    rows = _details(spark, d)
    return reports.metric_deltas(balance.summarize(rows), balance.summarize(rows.filter("expected_kind = 'official'")))


@query(
    """SELECT p.provider_id, c.url, c.source, p.k AS query_pos FROM (SELECT provider_id, unnest(['"' || provider_name || '" official website', '"' || provider_name || '" contact']) AS query, unnest([0, 1]) AS k FROM {providers}) p
    JOIN (SELECT '"' || provider_name || '" contact' AS query, url, source FROM (SELECT * FROM {candidates}) a JOIN (SELECT * FROM {providers}) b ON a.provider_id = b.provider_id) c ON p.query = c.query"""
)
def c3_collected(spark, d):
    named = load(spark, d, "providers").select("provider_id", "provider_name")
    asked = named.select("provider_id", F.posexplode(F.slice(verification.independent_queries(F.col("provider_name"), F.array().cast("array<string>")), 1, 2)).alias("query_pos", "query"))
    found = load(spark, d, "candidates").join(named, "provider_id").select(F.concat(F.lit('"'), "provider_name", F.lit('" contact')).alias("query"), F.lit(0).alias("source_pos"), F.col("pos").alias("rank"), "url", "source")
    return reports.collected(asked, found).select("provider_id", "url", "source", F.col("pos.query_pos").alias("query_pos"))


_SECOND = """s AS (SELECT r.provider_id, r.status AS previous_status, CASE WHEN r.pos % 4 = 0 THEN r.status WHEN r.pos % 4 = 1 THEN 'matched' ELSE r.status END AS status, r.pos % 4 IN (0, 1) AS accepted, r.pos % 4 = 1 AS rescue_used,
      CASE WHEN r.pos % 4 = 1 THEN 'https://www.rescued' || r.pos || '.com' ELSE 'https://first' || r.pos || '.com' END AS official_url, CASE WHEN r.pos % 4 = 1 THEN 88 ELSE 60 END AS confidence FROM (SELECT * FROM {results}) r WHERE r.status <> 'matched')"""


def _second_pass(spark, d):
    rows = load(spark, d, "results").filter("status <> 'matched'")
    first = rows.select("provider_id", (F.col("pos") % 4 == 0).alias("accepted"), "status", F.concat(F.lit("https://first"), "pos", F.lit(".com")).alias("official_url"), F.lit(60).alias("confidence"))
    rescued = rows.filter("pos % 4 < 3").select("provider_id", (F.col("pos") % 4 < 2).alias("accepted"), F.lit("matched").alias("status"), F.concat(F.lit("https://www.rescued"), "pos", F.lit(".com")).alias("official_url"), F.lit(88).alias("confidence"))
    return reports.with_rescue(first, rescued)


@query(f"WITH {_SECOND} SELECT provider_id, accepted, status, official_url, confidence, rescue_used FROM s")
def g15_rescue(spark, d):
    return _second_pass(spark, d)


@query(
    f"""WITH {_SECOND} SELECT provider_id, previous_status, official_url, regexp_replace(official_url, '^https://(www[.])?', '') AS official_domain, CAST(confidence AS VARCHAR) AS confidence, status, CASE WHEN accepted THEN 'true' ELSE 'false' END AS accepted_for_final,
    CASE WHEN rescue_used THEN 'second_pass_rescue_verify_accept' WHEN accepted THEN 'second_pass_auto_accept' ELSE 'second_pass_review_required' END AS notes FROM s"""
)
def g16_second_pass_rows(spark, d):
    planned = load(spark, d, "results").select("provider_id", "status", "confidence", F.lit("").alias("strategy_tier"))
    return reports.second_pass_rows(planned, _second_pass(spark, d)).select("provider_id", "previous_status", "official_url", "official_domain", "confidence", "status", "accepted_for_final", "notes")


@query(
    f"""WITH {_SECOND} SELECT provider_id, 'replace' AS manual_decision, official_url AS manual_url, CASE WHEN rescue_used THEN 'second_pass_rescue_verify_accept' ELSE 'second_pass_auto_accept' END || ' confidence=' || confidence || ' tier=B' AS notes, status AS source_status FROM s WHERE accepted"""
)
def g16_decision_rows(spark, d):
    planned = load(spark, d, "results").select("provider_id", "status", "confidence", F.lit("B").alias("strategy_tier"))
    return reports.second_pass_decisions(reports.second_pass_rows(planned, _second_pass(spark, d))).drop("confidence")
