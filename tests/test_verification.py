"""Verification scores, further searches and replacements."""

from siteresolve.operators import pages, verification
from siteresolve.sources import readers

ABOUT = """<html><head><title>Acme Widgets</title><script type="application/ld+json">{"@type": "Organization", "name": "Acme Widgets", "legalName": "Acme Widgets Ltd", "address": "Bonn, Germany"}</script></head>
<body><h1>Hello</h1><p>Acme Widgets, a limited company in Germany. Contact us, privacy policy.</p><a href="mailto:a@acme.de">m</a><footer>end</footer></body></html>"""


def test_verified_sites(spark):
    crawl = spark.createDataFrame([("https://acme.de/", ABOUT), ("https://acme.de/about", "<p>About us"), ("https://www.acme.de/contact", "<p>not under the first root"), ("https://other.com/", "<p>this domain may be for sale")], "url string, html string")
    rows = [("1", 0, "acme.de"), ("1", 1, "https://other.com/profile"), ("1", 2, "https://none.org"), ("1", 3, ""), ("1", 4, "https://www.linkedin.com/company/acme")]
    found = spark.createDataFrame([(*r, "Acme Widgets", ["Germany"]) for r in rows], "provider_id string, pos int, url string, provider_name string, provider_locations array<string>")
    got = {r["pos"]: r for r in verification.verify_sites(found, pages.read_pages(crawl)).collect()}
    assert got[0]["evidence_urls"] == ["https://acme.de/", "https://acme.de/about"] and got[0]["counter_evidence"] == []
    assert got[0]["supporting_facts"] == [
        "page_h1_seen", "footer_text_seen", "mailto_link_found", "page_role:home", "page_role:contact", "page_role:about", "candidate_pages_fetch_ok", "page_contains_exact_provider_name",
        "standard_company_pages_found", "about_and_contact_pages_found", "location_matches:Germany", "schema_org_name_matches_provider", "schema_org_legal_name_seen", "schema_org_address_seen",
        "schema_or_page_location_matches:Germany", "schema_org_organization_seen",
    ]
    assert got[0]["score"] == 100  # 15 + 30 + 8 + 5 + 5 + 7 and 36 for the organization; legal forms are no part of normalized text
    assert got[1]["score"] == 15 - 35 - 35 - 12 and got[1]["counter_evidence"][:1] == ["candidate_looks_platform_profile"]
    assert "candidate_looks_parked_or_domain_sale" in got[1]["counter_evidence"] and "candidate_not_independent_official_site" in got[1]["counter_evidence"]
    assert got[2]["score"] == -12 and got[2]["counter_evidence"] == ["candidate_pages_not_fetchable", "provider_name_not_found_on_candidate_pages", "identity_gap_location_or_service_context_missing"]
    assert (got[3]["score"], got[3]["counter_evidence"]) == (0, []) and (got[4]["score"], got[4]["counter_evidence"]) == (-100, ["excluded_domain"])


def test_trusted_labels(spark, tmp_path):
    for name in ("x_Manual_Review_Combined_Decisions.csv", "my_manual_notes.csv", "reviewed_filled.csv"):
        (tmp_path / name).write_text("provider_id,manual_decision\n1,accept\n")
    rows = readers.trusted_labels(spark, str(tmp_path)).collect()
    assert [r["provider_id"] for r in rows] == ["1"] and "Combined_Decisions" in rows[0]["label_source_path"]
