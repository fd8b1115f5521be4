"""Search providers: queries in, ranked results out, asked in the tasks that hold the queries."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..vocabulary import MAX_RESULTS

RESULT = "title string, url string, snippet string, rank int, engine string, query string"


class ProviderError(RuntimeError):
    """No provider can be used, or one refuses."""


@dataclass(frozen=True)
class Provider:
    """A search engine: ``fetch`` gets a query and a number and returns its results as JSON-like dicts."""

    name: str
    title_field: str = "title"
    url_fields: tuple[str, ...] = ("url",)
    snippet_field: str = "content"
    fetch: object = None

    def results(self, query: str, most: int = MAX_RESULTS) -> Iterator[tuple]:
        """Ranks count from 1 before results without a url go, so gaps stay."""
        if self.fetch is None:
            raise ProviderError(f"{self.name} can't be reached")
        for rank, item in enumerate(self.fetch(query, most)[:most], 1):
            url = next((item[f] for f in self.url_fields if item.get(f)), "")
            if url:
                yield item.get(self.title_field) or "", url, item.get(self.snippet_field) or "", rank, self.name, query


def mock(fixture: list[dict]) -> Provider:
    """The same results for every query."""
    return Provider("mock", snippet_field="snippet", fetch=lambda _query, _most: fixture)


@dataclass(frozen=True)
class Endpoint:
    """Where and how an engine is asked over HTTP; ``{query}``, ``{n}`` and ``{page}`` in the url are filled in, quoted.

    With a body the request is a POST of that mapping as JSON, with the query under ``query_key`` and the number of results under ``number_key``. ``delay`` seconds pass
    before every request but a task's first, so that an engine isn't overrun.
    """

    url: str
    headers: dict[str, str] = field(default_factory=dict)
    body: dict | None = None
    query_key: str = "query"
    number_key: str = "max_results"
    page: int = 1
    delay: float = 0.0
    timeout: float = 30.0
    tries: int = 3

    def request(self, query: str, most: int):
        import urllib.parse
        import urllib.request

        url = self.url.format(query=urllib.parse.quote_plus(query), n=most, page=self.page)
        if self.body is None:
            return urllib.request.Request(url, headers=self.headers)
        body = json.dumps({**self.body, self.query_key: query, self.number_key: most}, ensure_ascii=False).encode()
        return urllib.request.Request(url, data=body, headers={"Content-Type": "application/json", **self.headers}, method="POST")


def found_items(payload: dict | list) -> list[dict]:
    """The results in a JSON answer: under ``results`` or ``data``, there as a list or under ``web``, or the answer itself."""
    found = payload
    for key in ("results", "data", "web"):
        if isinstance(found, dict) and found.get(key):
            found = found[key]
    return [item for item in found if isinstance(item, dict)] if isinstance(found, list) else []


def http(name: str, endpoint: Endpoint | str, opener=None, **fields) -> Provider:
    """A provider behind a JSON endpoint. A refusal ends the search; otherwise there are some tries, waiting longer each time, at most ten seconds."""
    endpoint = Endpoint(endpoint) if isinstance(endpoint, str) else endpoint
    asked = []

    def fetch(query: str, most: int) -> list[dict]:
        import time
        import urllib.error
        import urllib.request

        send = opener or (lambda request: urllib.request.urlopen(request, timeout=endpoint.timeout))
        if asked and endpoint.delay:
            time.sleep(endpoint.delay)
        asked.append(1)
        for k in range(endpoint.tries):
            if k:
                time.sleep(min(10, 2 ** (k - 1)))
            try:
                with send(endpoint.request(query, most)) as answer:
                    return found_items(json.load(answer))
            except urllib.error.HTTPError as e:
                if e.code in (401, 403):
                    raise ProviderError(f"{name} refuses: is its key right, and its JSON format enabled?") from e
            except OSError:
                pass
        raise ProviderError(f"{name} doesn't answer")

    return Provider(name, fetch=fetch, **fields)


#: Each provider's field names, in the order in which they are asked.
FIELDS = {
    "mock": {"snippet_field": "snippet"},
    "searxng": {},
    "ddgs": {"url_fields": ("href", "url"), "snippet_field": "body"},
    "tavily": {},
    "firecrawl": {"snippet_field": "description"},
}


def endpoint_for(name: str, own: dict) -> Endpoint:
    """How each engine is asked, from its settings: url, key, page, delay. Two of them need a key, and get the query by POST."""
    more = {k: own[k] for k in ("page", "delay", "timeout") if k in own}
    if name == "searxng":
        return Endpoint(own["url"].rstrip("/") + "/search?q={query}&format=json&pageno={page}", **more)
    if name in ("tavily", "firecrawl"):
        if not own.get("key"):
            raise ProviderError(f"{name} needs a key")
        url = own.get("url") or {"tavily": "https://api.tavily.com/search", "firecrawl": "https://api.firecrawl.dev/v1/search"}[name]
        return Endpoint(url, {"Authorization": f"Bearer {own['key']}"}, {}, number_key="max_results" if name == "tavily" else "limit", **more)
    if not own.get("url"):
        raise ProviderError(f"{name} needs the url of a JSON endpoint")
    return Endpoint(own["url"], **more)


def enabled(settings: dict[str, dict], mock_fixture: list[dict] | None = None) -> list[Provider]:
    """The providers that are on, in order; a mock fixture stands in for all of them."""
    if mock_fixture is not None:
        return [mock(mock_fixture)]
    found = [
        http(name, endpoint_for(name, settings[name]), **fields) for name,
        fields in FIELDS.items() if name != "mock" and settings.get(name, {}).get("enabled")
    ]
    if not found:
        raise ProviderError("no search provider is enabled")
    return found


def healthy(provider: Provider) -> bool:
    try:
        return any(True for _ in provider.results("test", 1))
    except ProviderError:
        return False


def search(queries: DataFrame, providers: list[Provider], most: int = MAX_RESULTS, query_col: str = "query") -> DataFrame:
    """The results of every query with every provider, asked in the tasks that hold the queries."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = [row for q in batch[query_col] for p in providers for row in p.results(q, most)]
            yield pd.DataFrame(rows, columns=["title", "url", "snippet", "rank", "engine", "query"])

    return queries.select(query_col).mapInPandas(run, RESULT)


def candidates(results: DataFrame, date: str, source_types: DataFrame) -> DataFrame:
    """Search results as new url candidates; normalized_url and domain are still empty."""
    typed = results.join(source_types.select("query", "source_type"), "query", "left")
    return typed.select(
        "url", F.lit("").alias("normalized_url"), F.lit("").alias("domain"), "title", "snippet", F.col("query").alias("query_used"),
        F.col("engine").alias("search_engine"), F.col("rank").cast("string").alias("rank"),
        F.lit(date).alias("discovered_date"), F.coalesce("source_type", F.lit("")).alias("source_type"), F.lit("new").alias("status"), F.lit("").alias("notes"),
    )
