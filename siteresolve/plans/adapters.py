"""The star-schema tables as the library's inputs.

Each adapter is one SELECT that Spark and the checking engine both run, over the same tables; names
in braces are the base tables or other adapters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels", "conversations"]

_COUNTRY = (
    "CASE n_nationkey % 8 WHEN 0 THEN 'Germany' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'Ukraine' WHEN 3 THEN 'Atlantis' WHEN 4 THEN 'Brasil' WHEN 5 THEN 'France' WHEN 6 THEN 'Poland' ELSE 'United States of America' END"
)

ADAPTERS: dict[str, str] = {
    # directory rows: one per provider and service
    "raw_rows": f"""
        SELECT CAST(l_suppkey AS STRING) AS provider_id, s_name AS provider_name, p_type AS service_api, {_COUNTRY} AS location, l_returnflag AS language,
               CAST(l_orderkey * 10 + l_linenumber AS BIGINT) * 100000 + l_partkey AS pos
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{part}} ON l_partkey = p_partkey""",
    "providers": f"""
        SELECT CAST(c_custkey AS STRING) AS provider_id, replace(c_name, '#0000', CASE WHEN c_custkey % 3 = 0 THEN ' Global ' ELSE ' Marketplace ' END) AS provider_name, c_mktsegment AS segment,
               {_COUNTRY} AS location, c_custkey AS pos
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "results": """
        SELECT CAST(c_custkey AS STRING) AS provider_id, c_name AS provider_name, c_custkey AS pos,
               CASE WHEN c_acctbal > 6000 THEN 'matched' WHEN c_acctbal > 2000 THEN 'needs_review' WHEN c_acctbal > 0 THEN 'low_confidence' ELSE 'not_found' END AS status,
               CASE WHEN c_custkey % 41 = 0 THEN '' ELSE CAST(CAST(floor(abs(c_acctbal) / 100) AS INT) AS STRING) END AS confidence,
               CASE WHEN c_acctbal > 2000 AND c_custkey % 17 = 0 THEN 'https://www.linkedin.com/in/' || c_custkey
                    WHEN c_acctbal > 2000 THEN 'www.' || lower(replace(c_name, '#', '-')) || CASE WHEN c_custkey % 5 = 0 THEN '.de/login/x' WHEN c_custkey % 5 = 1 THEN '.co.uk/.' ELSE '.com/Shop/' END
                    ELSE '' END AS official_url
        FROM {customer}""",
    "decisions": """
        SELECT CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS provider_id, upper(c_name) AS provider_name, o_orderkey AS pos,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Accept ' WHEN '2-HIGH' THEN 'replace' WHEN '3-MEDIUM' THEN 'no' WHEN '4-NOT SPECIFIED' THEN '' ELSE 'maybe' END AS manual_decision,
               CASE WHEN o_orderstatus = 'F' THEN '//site' || o_orderkey || '.fr/a.' ELSE '' END AS manual_url,
               CASE WHEN o_orderstatus = 'O' THEN 'seen' ELSE '' END AS notes
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # labels against output: documents are entities, their source the expected site, the label the kind
    "entity_labels": """
        SELECT CAST(l.doc_id AS STRING) AS provider_id, '' AS provider_name, CASE WHEN quality = 1 THEN 'official' ELSE 'no_official' END AS expected_kind,
               CASE WHEN quality = 1 THEN d.source || '.com' ELSE '' END AS expected_domain
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    "entity_output": """
        SELECT CAST(doc_id AS STRING) AS provider_id, '' AS provider_name, doc_id AS pos,
               CASE WHEN doc_id % 4 = 0 THEN 'unresolved' ELSE 'matched' END AS status, CASE WHEN doc_id % 23 = 0 THEN 'n/a' ELSE CAST(n_chars % 101 AS STRING) END AS confidence,
               CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 7 = 0 THEN 'https://elsewhere.org/x?y=1' ELSE 'https://www.' || source || '.com/' || lang || '/' END AS official_url, '' AS official_domain,
               CASE WHEN doc_id % 3 = 0 THEN lang || '_lane' END AS review_reason
        FROM {documents}""",
    # candidate sites per customer, from orders
    "candidates": """
        SELECT CAST(o_custkey AS STRING) AS provider_id, o_orderkey AS pos,
               CASE WHEN o_orderkey % 11 = 0 THEN 'https://www.facebook.com/p' WHEN o_orderkey % 4 = 0 THEN 'https://WWW.Site' || (o_orderkey % 6) || '.com/' ELSE 'http://site' || (o_orderkey % 9) || '.co.uk' END AS url,
               CASE o_orderstatus WHEN 'F' THEN 'domain_guess' WHEN 'O' THEN 'brave' ELSE 'serper' END AS source,
               CAST(floor(o_totalprice / 5000) AS INT) AS score, o_orderkey % 11 = 0 AS reject,
               'See www.shop' || (o_orderkey % 5) || '.de, or mail.' AS snippet, 'Title ' || o_orderkey AS title
        FROM {orders}""",
    # evidence features of order lines; right if the tax is low
    "evidence": """
        SELECT l_orderkey * 10 + l_linenumber AS row_id, l_partkey || ':' || l_suppkey || ':' || CAST(l_extendedprice * 100 AS BIGINT) || ':' || l_shipdate AS tie, 'flag:' || l_returnflag AS f1, 'status:' || l_linestatus AS f2,
               CASE WHEN l_quantity >= 40 THEN 'quantity>=40' WHEN l_quantity >= 20 THEN 'quantity>=20' END AS f3, CASE WHEN l_discount >= 0.08 THEN 'has:discount' ELSE 'missing:discount' END AS f4,
               CASE WHEN l_returnflag = 'N' AND l_quantity >= 40 THEN TRUE ELSE l_tax <= 0.04 END AS correct
        FROM {lineitem}""",
    # evidence with many features: wrong by brand and type, and for some returned lines
    "lane_rows": """
        SELECT l_orderkey * 10 + l_linenumber AS row_id, 'brand:' || p_brand AS f1, 'type:' || p_type AS f2, 'flag:' || l_returnflag AS f3,
               NOT ((CAST(replace(p_brand, 'Brand#', '') AS INT) * 7 + length(p_type)) % 5 = 0 OR (l_returnflag = 'R' AND l_tax >= 0.08 AND p_size < 20)) AS correct
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # regression cases per customer, from orders
    "cases": """
        SELECT CAST(o_custkey AS STRING) AS provider_id, o_orderkey AS pos,
               CASE o_orderkey % 4 WHEN 0 THEN 'precision_blocking_fixture' WHEN 1 THEN 'precision_positive_fixture' WHEN 2 THEN 'recall_blocking_fixture' ELSE 'recall_positive_fixture' END AS case_type,
               CASE WHEN o_orderstatus = 'F' THEN 'https://fixed' || (o_orderkey % 3) || '.com' WHEN o_orderkey % 2 = 1 THEN 'https://www.' || lower(replace(c_name, '#', '-')) || '.com/Shop/' ELSE '' END AS expected_url,
               CASE WHEN o_orderstatus = 'P' THEN 'http://' || lower(replace(c_name, '#', '-')) || '.com/Shop' ELSE 'https://other.org' END AS candidate_url, '' AS official_url
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # verification rows per customer, from orders
    "checks": """
        SELECT CAST(o_custkey AS STRING) AS provider_id, replace(c_name, '#0000', CASE WHEN c_custkey % 3 = 0 THEN ' Global ' ELSE ' Marketplace ' END) AS provider_name, o_orderkey AS pos,
               CASE o_orderkey % 4 WHEN 0 THEN 'accept' WHEN 1 THEN 'replace' WHEN 2 THEN 'reject' ELSE 'unsure' END AS decision,
               CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN 'https://www.customer.com/' WHEN o_orderkey % 7 = 2 THEN 'https://www.linkedin.com/company/' || o_custkey ELSE 'https://www.site' || (o_orderkey % 300) || '.com/a' END AS candidate_url,
               CASE WHEN o_orderkey % 4 = 1 THEN 'https://new' || (o_orderkey % 3) || '.co.uk/x' ELSE '' END AS replacement_url, CAST(CAST(floor(o_totalprice / 5000) AS INT) AS STRING) AS evidence_score,
               CASE o_orderstatus WHEN 'F' THEN 'candidate_pages_fetch_ok; location_matches:Germany' WHEN 'O' THEN 'listing_logo_visual_match;page_contains_exact_provider_name; ' ELSE '' END AS supporting_facts,
               CASE WHEN o_orderkey % 5 = 0 THEN 'candidate_looks_directory_page' WHEN o_orderkey % 5 = 1 THEN 'provider_name_not_found_on_candidate_pages;identity gap' ELSE '' END AS counter_evidence,
               CASE WHEN o_orderkey % 12 = 3 THEN 'agent_b_row_timeout' WHEN o_orderkey % 4 = 3 THEN 'insufficient_or_conflicting_evidence' ELSE '' END AS reason_for_unsure,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'recall_unresolved_top_candidate' WHEN '2-HIGH' THEN 'precision_low_confidence_auto_match' WHEN '3-MEDIUM' THEN 'precision_slug_extension_identity_risk' WHEN '5-LOW' THEN 'precision_generic_identity_term_risk' ELSE '' END AS review_reason,
               CASE WHEN o_orderkey % 2 = 1 THEN 'query ' || (o_orderkey % 500) || '; query ' || o_orderkey ELSE '' END AS independent_search_queries
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # filled review sheets per customer, from orders: some words aliased, some addresses in cells
    "filled": """
        SELECT CAST(o_custkey AS STRING) AS provider_id, c_name AS provider_name, o_orderkey AS pos,
               CASE o_orderkey % 6 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'override' WHEN 2 THEN 'no' WHEN 3 THEN 'unsure' WHEN 4 THEN '' ELSE 'later' END AS manual_decision,
               CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 3 WHEN 0 THEN '=' ELSE '' END || CASE o_orderkey % 2 WHEN 0 THEN 'HYPERLINK' ELSE 'hyperlink' END || '("https://www.own' || (o_orderkey % 50) || '.de/x).", "go")' WHEN o_orderstatus = 'P' THEN 'own' || (o_orderkey % 50) || '.fr' ELSE '' END AS manual_url,
               CASE WHEN o_orderkey % 3 = 0 THEN 'https://www.shown' || (o_orderkey % 40) || '.com/' ELSE '' END AS official_url,
               CASE WHEN o_orderkey % 3 = 1 THEN '=HYPERLINK("http://Now' || (o_orderkey % 40) || '.org/a;b", "x")' ELSE '' END AS current_or_candidate_url
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # review work: events are filled rows, the type is the lane
    "work": """
        SELECT CAST(user_id AS STRING) AS provider_id, event_type AS review_reason, event_id AS seq, CAST(floor(value) AS INT) AS score,
               CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN 'accept' ELSE 'reject' END AS manual_decision, CASE WHEN event_id % 3 = 1 THEN 'https://u' || (event_id % 2) || '.com' ELSE '' END AS manual_url
        FROM {events}""",
}


def sql(text: str) -> str:
    """``text`` with adapters written out as sub-queries, for an engine that has the base tables as views."""
    while True:
        names = [n for n in ADAPTERS if "{" + n + "}" in text]
        if not names:
            break
        for n in names:
            text = text.replace("{" + n + "}", f"({ADAPTERS[n]}) AS {n}")
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or an adapter over the base tables it names."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = ADAPTERS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
