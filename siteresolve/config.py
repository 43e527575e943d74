"""Thresholds and fixed tables of the site-resolution jobs."""

from __future__ import annotations

ACCEPT_SCORE = 75
REVIEW_SCORE = 45

# Hosts that are never a company's own site. One ending in a dot is a host label.
EXCLUDED_DOMAINS = [
    "amazon.", "sellercentral.", "media-amazon.", "amazonaws.com", "linkedin.com", "facebook.com", "instagram.com", "x.com", "twitter.com",
    "youtube.com", "vimeo.com", "tiktok.com", "crunchbase.com", "f6s.com", "scamadviser.com", "trustpilot.com", "trustburn.com",
    "rocketreach.co", "zoominfo.com", "bing.com", "finance.yahoo.com", "einpresswire.com", "fiverr.com", "upwork.com", "clutch.co",
    "goodfirms.co", "scribd.com", "slideshare.net", "issuu.com", "docplayer.net", "zaubacorp.com", "thecompanycheck.com", "planetexim.net",
    "tracxn.com", "sensibook.com", "cleartax.in", "kompass.com", "exportersindia.com", "scale-jet.com", "b2brazil.com", "indiamart.com",
    "mycorporateinfo.com", "tradewheel.com", "hugedomains.com", "atom.com", "all.biz", "itch.io", "recaptcha.cloud", "zendesk.", "new.",
    "myshopify.com", "opencorporates.com", "company-information.service.gov.uk",
]

# Words of the services looked for in snippets and pages.
SERVICE_KEYWORDS = [
    "amazon", "seller central", "seller", "marketplace", "account management", "advertising", "ppc", "catalog", "compliance", "fba",
    "translation", "tax", "shipping", "ecommerce", "e-commerce",
]

# Top-level domains that say nothing about a country.
GENERIC_TLDS = ["com", "co", "io", "net", "org", "biz", "info", "agency", "digital", "marketing", "consulting", "solutions", "services", "top", "xyz", "ai"]

# Code, names, top-level domains, terms for an official site, terms for the services.
COUNTRIES = [
    ("US", ["united states", "united states of america", "usa", "u.s.", "u.s.a.", "america"], ["us"], ["official website", "contact us", "about us"], ["amazon agency", "amazon account management", "amazon advertising"]),
    ("GB", ["united kingdom", "uk", "great britain", "england"], ["uk", "co.uk"], ["official website", "contact us", "companies house"], ["amazon agency", "seller central agency"]),
    ("DE", ["germany", "deutschland"], ["de"], ["offizielle website", "offizielle seite", "kontakt", "impressum"], ["amazon agentur", "amazon seller central", "marktplatz agentur"]),
    ("IT", ["italy", "italia"], ["it"], ["sito ufficiale", "contatti", "chi siamo", "partita iva"], ["agenzia amazon", "gestione account amazon", "marketplace amazon"]),
    ("BR", ["brazil", "brasil"], ["br", "com.br"], ["site oficial", "contato", "sobre", "cnpj"], ["agencia amazon", "gestao de marketplace", "gestao de conta amazon"]),
    ("PT", ["portugal"], ["pt"], ["site oficial", "contacto", "sobre"], ["agencia amazon", "gestao de marketplace"]),
    ("FR", ["france"], ["fr"], ["site officiel", "contact", "a propos", "mentions legales", "siren"], ["agence amazon", "gestion compte amazon", "marketplace amazon"]),
    ("ES", ["spain", "espana", "españa"], ["es"], ["sitio web oficial", "contacto", "sobre nosotros", "cif"], ["agencia amazon", "gestion cuenta amazon", "marketplace amazon"]),
    ("SK", ["slovakia", "slovak republic", "slovensko"], ["sk"], ["oficialna stranka", "kontakt", "o nas"], ["amazon agentura", "sprava amazon uctu"]),
    ("UA", ["ukraine", "ukraina"], ["ua", "com.ua"], ["official site", "kontakt", "oficiinyi sait"], ["amazon agency", "amazon marketplace"]),
    ("PL", ["poland", "polska"], ["pl"], ["oficjalna strona", "kontakt", "o nas"], ["agencja amazon", "obsluga konta amazon"]),
    ("IN", ["india", "bharat"], ["in", "co.in"], ["official website", "contact us", "mca", "gst"], ["amazon seller services", "marketplace management"]),
    ("MX", ["mexico", "méxico"], ["mx", "com.mx"], ["sitio oficial", "contacto", "acerca de"], ["agencia amazon", "gestion marketplace"]),
    ("NL", ["netherlands", "nederland", "holland"], ["nl"], ["officiele website", "contact", "over ons"], ["amazon bureau", "marketplace management"]),
]

# What reviewers write, and what it means.
DECISIONS = {
    "accept": "accept", "approve": "accept", "approved": "accept", "confirm": "accept", "confirmed": "accept", "yes": "accept", "接受": "accept", "确认": "accept",
    "replace": "replace", "override": "replace", "替换": "replace",
    "reject": "reject", "rejected": "reject", "not_found": "reject", "no": "reject", "拒绝": "reject", "否": "reject",
}

STATUSES = ["matched", "needs_review", "low_confidence", "not_found", "manual_accepted", "calibrated_released", "rejected", "unresolved", "invalid_manual_decision"]
