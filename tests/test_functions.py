from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorebed.functions import fuzzy, records, text, urls
from lorebed.operators.candidates import classify
from lorebed.vocabulary import TRACKING_PARAMETERS


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [r[1] for r in rows.select("i", make(F.col("v"))).orderBy("i").collect()]


def plain_normal_form(url: str) -> str:
    url = url.strip()
    if not url:
        return ""
    parts = urlsplit(url if "://" in url else "https://" + url)
    host = parts.netloc.lower()
    for port in (":443", ":80"):
        if host.endswith(port):
            host = host[: -len(port)]
            break
    query = sorted({(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k.lower() not in TRACKING_PARAMETERS})
    return urlunsplit(("https" if parts.scheme == "http" else parts.scheme, host, parts.path.rstrip("/"), urlencode(query), ""))


URLS = [
    "https://example.com/news/plant?utm_source=x&utm_medium=y&fbclid=abc&id=7", "https://example.com/a/b/#section", "https://example.com/", "http://Example.COM/Path", "https://example.com/p?b=2&a=1&b=2",
    "example.com/x", " https://e.com/a?x=%20y&z=a+b ", "https://e.com:443/a", "https://e.com:8080/a/", "https://e.com/a?a-b=1&a=2", "https://e.com/?q=~*é", "https://e.com/a;b?a=1;c=2", "https://e.com/%7Eu/?", "", "https://e.com?x",
    "https://u:p@E.com/", "ftp://e.com/x//", "https://e.com/a?=1&&b=",
]


def test_normalize_url_as_plain_python(spark):
    assert column(spark, URLS, urls.normalize_url) == [plain_normal_form(u) for u in URLS]


def test_normalize_url_golden(spark):
    got = column(spark, URLS[:5] + [None], urls.normalize_url)
    assert got == ["https://example.com/news/plant?id=7", "https://example.com/a/b", "https://example.com", "https://example.com/Path", "https://example.com/p?a=1&b=2", ""]


def test_host_and_domain(spark):
    assert column(spark, ["https://Gov.Georgia.gov/press/x", "https://a.b.co.uk/", "localhost:80"], urls.get_host) == ["gov.georgia.gov", "a.b.co.uk", "localhost"]
    assert column(spark, ["https://gov.georgia.gov/press/x", "https://a.b.co.uk/", "https://localhost/"], urls.get_domain) == ["georgia.gov", "b.co.uk", "localhost"]


def test_classify(spark):
    given_ = ["https://gov.georgia.gov/x", "https://www.ajc.com/", "https://a.blogspot.com/", "https://www.facebook.com/", "https://unknown.example/", "https://fedex.com/", ".gov"]
    assert column(spark, given_, classify) == ["high", "medium", "low", "skip", "medium", "skip", "high"]


def test_white_space_and_case_as_python(spark):
    odd = ["\x1c a b \x85", "　x ", "Straße ſ", "ΑΣ", None, "", " \t\n"]
    assert column(spark, odd, text.strip) == [x if x is None else x.strip() for x in odd]
    assert column(spark, odd, text.fold_spaces) == [" ".join((x or "").split()).casefold() for x in odd]
    assert column(spark, odd, text.casefold) == [x if x is None else x.casefold() for x in odd]


def test_case_folding_of_every_code_point(spark):
    """In texts of neighbours, of all ASCII with one other, and with Latin-1 letters beside."""
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF]
    texts = ["".join(points[i : i + 64]) for i in range(0, len(points), 64)] + [f"Aß{c}É" for c in points if c.casefold() != c or c.lower() != c]
    assert column(spark, texts, text.casefold) == [x.casefold() for x in texts]


def test_ids_and_slugs(spark):
    assert column(spark, [7, 1234567], text.page_id, "long") == ["page_000007", "page_1234567"]
    assert column(spark, ["SK Battery America!", "a" * 59 + " b", "--"], text.slug) == ["sk-battery-america", "a" * 59, ""]
    assert column(spark, ["true", " TRUE\t", "1", "", None], text.truthy) == [True, True, False, False, False]


def test_coercions(spark):
    assert column(spark, ["1.7", "-3", "n/a", None, "nan", "0.5"], records.confidence) == [1.0, 0.0, 0.0, 0.0, 0.0, 0.5]
    assert column(spark, [200000000, None], records.as_text, "long") == ["200000000", ""]
    assert column(spark, ["ACME Inc", "", None], records.as_list) == [["ACME Inc"], [], []]
    (a, b), (c, _) = (column(spark, ["https://x.com/1", u], lambda v: records.wiki_id(v, F.lit("Acme"), F.lit("A plant."))) for u in ("https://x.com/1", "https://x.com/2"))
    assert a == b == c and len(a) == 16


def test_currency(spark):
    dates = ["2023-09-01", "2024-01-01", "2023-06", "2021-01-01", "", "2025-13-01"]
    made = column(spark, dates, lambda v: records.currency(records.published(v), F.lit("2024-08-31").cast("date")))
    assert made == ["fresh", "fresh", "aging", "stale", "undated", "undated"]


def test_names(spark):
    assert column(spark, ["Ascend Elements, Inc.", "Ascend Elements LLC", "SK Battery America", None], records.normalize_name) == ["ascend elements", "ascend elements", "sk battery america", ""]


PAGE = "# georgia battery plant example battery company announced a $200 million battery materials facility in bryan county, georgia, creating 350 jobs."


@pytest.mark.parametrize(("a", "b", "least", "most"), [("hyundai mobis georgia", "hyundai mobis alabama", 71, 72), ("ascend elements", "ascend element", 96, 97), ("ascend elements", "sk battery america", 0, 40)])
def test_token_sort_ratio(a, b, least, most):
    assert least <= fuzzy.token_sort_ratio(a, b) <= most


def test_partial_ratio_of_claims():
    assert fuzzy.partial_ratio("example battery company announced a $200 million battery materials facility in bryan county georgia creating 350 jobs", PAGE) > 98
    assert fuzzy.partial_ratio("the company opened a gigafactory in nevada with 5,000 workers.", PAGE) < 50


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@given(st.text("abc ", min_size=1, max_size=20), st.text("abcd ", min_size=20, max_size=70), st.sampled_from([0, 60, 85]))
def test_partial_ratio_as_brute_force(a, b, cutoff):
    m = len(a)
    best = max(200 * _common(a, w) / (m + len(w)) for w in (b[max(0, i) : i + m] for i in range(1 - m, len(b))))
    got = fuzzy.partial_ratio(a, b, cutoff)
    assert abs(got - (best if best >= cutoff else 0)) < 1e-9
