"""URL functions: canonical form, host, registered domain. All native but the public-suffix lookup."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import TRACKING_PARAMETERS
from .text import strip

_SPLIT = r"(?s)\A([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"


def _decoded(c: Column) -> Column:
    """As unquote_plus: what isn't a valid escape stays as it is."""
    spaced = F.replace(c, F.lit("+"), F.lit(" "))
    return F.coalesce(F.try_url_decode(c), spaced)


def _encoded(c: Column) -> Column:
    """As quote_plus, which leaves ``~`` alone and escapes ``*``."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _query(c: Column) -> Column:
    """Parameters without tracking ones and repeats, in order of key and value."""
    pairs = F.transform(
        F.filter(F.split(c, "&"), lambda x: x != ""),
        lambda x: F.struct(_decoded(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), _decoded(F.when(F.contains(x, F.lit("=")), F.substr(x, F.instr(x, "=") + 1)).otherwise("")).alias("v")),
    )
    kept = F.array_sort(F.array_distinct(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(TRACKING_PARAMETERS))))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def normalize_url(url: Column) -> Column:
    """The form in which equal urls are equal: https, host in lower case without a default port, no fragment, no tracking
    parameters, the others sorted without repeats, no slash at the end. An empty or null url is empty."""
    text = strip(F.coalesce(url, F.lit("")))
    text = F.regexp_replace(F.when(F.contains(text, F.lit("://")), text).otherwise(F.concat(F.lit("https://"), text)), "[\t\r\n]", "")
    part = lambda k: F.regexp_extract(text, _SPLIT, k)
    scheme = F.lower(part(1))
    scheme = F.when(scheme == "http", "https").otherwise(scheme)
    host = F.regexp_replace(F.lower(part(2)), ":(443|80)$", "")
    path = F.regexp_replace(part(3), "/+$", "")
    query = _query(part(4))
    rest = F.concat(path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    whole = F.concat(scheme, F.lit("://"), host, F.when((path != "") & ~F.startswith(path, F.lit("/")), F.lit("/")).otherwise(""), rest)
    return F.when(strip(F.coalesce(url, F.lit(""))) == "", "").when(scheme == "", text).otherwise(whole)


def get_host(url: Column) -> Column:
    """The host in lower case up to its first ``:``; what has no scheme counts as one with https."""
    text = strip(F.coalesce(url, F.lit("")))
    text = F.when(F.contains(text, F.lit("://")), text).otherwise(F.concat(F.lit("https://"), text))
    return F.split_part(F.lower(F.regexp_extract(text, _SPLIT, 2)), F.lit(":"), F.lit(1))


@cache
def public_suffixes() -> frozenset[str]:
    """The ICANN part of the public-suffix list that comes with Spark's http client, or the few commonest suffixes."""
    import pyspark

    for jar in sorted(Path(pyspark.__file__).parent.glob("jars/httpclient-4*.jar")):
        with zipfile.ZipFile(jar) as z:
            text = z.read("mozilla/public-suffix-list.txt").decode()
        return frozenset(line.strip() for line in text.partition("===BEGIN PRIVATE")[0].splitlines() if line.strip() and not line.startswith("//"))
    return frozenset(["com", "org", "net", "edu", "gov", "io", "co", "us", "uk", "co.uk", "de", "fr", "es"])


def registered(host: str, suffixes: Iterable[str]) -> str:
    """The label before the public suffix with the suffix; the host itself if it has none."""
    labels = host.split(".")
    for i in range(len(labels)):
        rest = ".".join(labels[i:])
        if "!" + rest in suffixes:
            return rest
        if rest in suffixes or "*." + ".".join(labels[i + 1 :]) in suffixes and i + 1 < len(labels):
            return ".".join(labels[i - 1 :]) if i else host
    return host


def get_domain(url: Column, suffixes: frozenset[str] | None = None) -> Column:
    """The registered domain of the url's host, else the host."""
    known = suffixes or public_suffixes()

    @F.pandas_udf("string")
    def lookup(hosts: pd.Series) -> pd.Series:
        found = {h: registered(h, known) for h in hosts.unique() if h is not None}
        return hosts.map(found)

    return lookup(get_host(url))
