"""Column functions against the plain rules they stand for."""

import re
import unicodedata
from urllib.parse import urlparse

from pyspark.sql import functions as F

from siteresolve.config import EXCLUDED_DOMAINS
from siteresolve.functions import geo, text, urls


def one(spark, values, make):
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", make(F.col("v")).alias("x")).orderBy("k").collect()
    return [r["x"] for r in rows]


def test_normalized(spark):
    names = ["Ünïcode GmbH & Co.", "ﬁne½ Ltd", "深圳公司", "Sp. z o.o. Foo", "", None, "ACME  Pvt Ltd", "№5 ™ Shop", "Straße", "áb", "Since Inc"]

    def plain(v):
        v = unicodedata.normalize("NFKD", v or "").encode("ascii", "ignore").decode().lower()
        return " ".join(re.sub("[^a-z0-9]+", " ", re.sub(text.LEGAL_FORMS, " ", v)).split())

    assert one(spark, names, text.normalized) == [plain(v) for v in names]


def test_domain(spark):
    given = [
        "http://www.A.com:80/x?y", "a.co.uk", "https://u:p@b.de/", "", "https:///x", "www.x.com", "//c.org/p", "ftp://q.r.s/", "foo/bar", "https://[::1", "a b",
        "x.com?z=http://u", "http://.dots.com./", "user@host.net:99/p", "HTTP://Www.Up.IO", "foo/http://x", "http://a@b@c.com",
    ]

    def plain(url):
        try:
            p = urlparse(url if "://" in url else f"https://{url}")
        except ValueError:
            return ""
        host = (p.netloc or p.path).lower().rsplit("@", 1)[-1].split(":", 1)[0].strip(".")
        return host.removeprefix("www.")

    assert one(spark, given, urls.domain) == [plain(u) for u in given]


def test_url_forms(spark):
    assert one(spark, ["a.com/Login", "//b.org/x.", "", None, "https://c.io/user/1?q"], urls.delivered) == ["https://a.com/", "https://b.org/x", "", "", "https://c.io/"]
    assert one(spark, ["https://www.A.com/b/", "a.com", ""], urls.site_key) == ["a.com/b", "a.com", ""]
    assert one(spark, ["http://www.a.com/x"], urls.roots) == [["http://www.a.com", "http://a.com", "https://www.a.com", "https://a.com"]]
    assert one(spark, ["go www.x.com, or y.de; (see https://z.org/p)."], urls.mentioned) == [["www.x.com", "y.de", "https://z.org/p"]]
    assert one(spark, ["a.b.co.uk", "x.com", "solo"], urls.base_label) == ["b", "x", "solo"]
    assert one(spark, ["a.b.co.uk", "x.com", "solo"], urls.suffix) == ["co.uk", "com", ""]


def test_excluded(spark):
    given = ["amazon.de", "sellercentral.amazon.com", "gozenix.com", "m.facebook.com", "notfacebook.com", "", "help.zendesk.com", "x.com"]
    assert one(spark, given, lambda c: urls.excluded(c, EXCLUDED_DOMAINS)) == [True, True, False, True, False, True, True, True]


def test_places(spark):
    where = lambda c: F.array(c)
    assert one(spark, ["Ukraine", "Deutschland", "Atlantis", None], lambda c: F.transform(geo.profiles(where(c)), lambda p: p["code"])) == [["GB", "UA"], ["DE"], [], []]
    assert one(spark, ["Germany", "France", "Atlantis"], lambda c: geo.domain_signal(F.lit("shop.de"), where(c))) == ["match", "conflict", "neutral"]
    assert one(spark, ["Germany"], lambda c: geo.domain_signal(F.lit("shop.com"), where(c))) == ["neutral"]


def test_cells(spark):
    assert one(spark, ['=HYPERLINK("https://a.b","go")', "plain", None], text.cell_url) == ["https://a.b", "plain", ""]
    assert one(spark, ['["a","b"]', "[1", '{"a":1}', None], text.json_list) == [["a", "b"], [], [], []]
    assert one(spark, ["72.9", "x", "", None, "-3.7", "45"], text.whole_number) == [72, 0, 0, 0, -3, 45]
