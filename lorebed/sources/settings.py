"""Settings from a YAML-like mapping, which the environment overrides."""

from __future__ import annotations

import logging
import os
import sys
from dataclasses import dataclass, field, replace
from pathlib import Path

from ..vocabulary import MAX_ITERATIONS, MAX_NEW_QUERIES, MAX_RESULTS


@dataclass(frozen=True)
class Settings:
    search_mock: bool = False
    llm_mock: bool = False
    searxng_url: str = ""
    max_iterations: int = MAX_ITERATIONS
    max_queries: int = MAX_NEW_QUERIES
    max_urls_to_crawl: int = 1000
    max_results_per_query: int = MAX_RESULTS
    providers: dict = field(default_factory=dict)
    #: Each file of the config folder, by its name without ``.yaml``.
    files: dict = field(default_factory=dict)


def flag(name: str, default: bool) -> bool:
    value = os.environ.get(name)
    return default if value is None else value.strip().lower() in {"1", "true", "yes", "on"}


def number(name: str, default: int) -> int:
    value = os.environ.get(name, "").strip()
    return int(value) if value else default


def load_yaml(path: str) -> dict:
    """A missing file is an error, an empty one an empty mapping. Needs PyYAML, which isn't always there."""
    text = Path(path).read_text(encoding="utf-8")
    import yaml

    return yaml.safe_load(text) or {}


def load(config: dict | None = None) -> Settings:
    base = Settings(**{k: v for k, v in (config or {}).items() if k in Settings.__dataclass_fields__})
    return replace(
        base, search_mock=flag("SEARCH_MOCK", base.search_mock), llm_mock=flag("LLM_MOCK", base.llm_mock),
        searxng_url=os.environ.get("SEARXNG_URL", base.searxng_url).rstrip("/"),
        max_iterations=number("MAX_DISCOVERY_ITERATIONS", number("MAX_ITERATIONS", base.max_iterations)),
        max_urls_to_crawl=number("MAX_URLS_TO_CRAWL", base.max_urls_to_crawl),
    )


# The files of a config folder, and the folders of a data folder.
CONFIG_FILES = ["search_config", "query_templates", "domain_priority", "crawler_config", "wiki_schema", "llm_config"]
DATA_FOLDERS = ["input", "urls", "crawled/markdown", "crawled/html", "wiki/page_inputs", "exports", "logs"]


def load_dir(folder: str, read=load_yaml) -> Settings:
    """All files of a config folder as one object, which the environment overrides; a missing file is an error."""
    files = {name: read(str(Path(folder) / f"{name}.yaml")) for name in CONFIG_FILES}
    search, crawler = files["search_config"], files["crawler_config"]
    engines = {name: dict(own) if isinstance(own, dict) else {} for name, own in (search.get("providers") or {}).items()}
    for name, variable in (("tavily", "TAVILY_API_KEY"), ("firecrawl", "FIRECRAWL_API_KEY")):
        if os.environ.get(variable):
            engines.setdefault(name, {})["key"] = os.environ[variable]
    if os.environ.get("SEARXNG_URL"):
        engines.setdefault("searxng", {})["url"] = os.environ["SEARXNG_URL"].rstrip("/")
    if flag("DDGS_ENABLED", False):
        engines.setdefault("ddgs", {})["enabled"] = True
    known = {**{k: v for k, v in {**crawler, **search}.items() if k in Settings.__dataclass_fields__}, "providers": engines, "files": files}
    base = load(known)
    return replace(base, max_results_per_query=number("MAX_RESULTS_PER_QUERY", int(base.max_results_per_query)))


def ensure_folders(root: str) -> list[str]:
    """Makes the folders of a data folder on this machine and names them; on other stores a write makes its own."""
    made = [Path(root) / name for name in DATA_FOLDERS]
    for folder in made:
        folder.mkdir(parents=True, exist_ok=True)
    return [str(folder) for folder in made]


def logger(name: str, file: str | None = None) -> logging.Logger:
    """To the console and a file, once, and not to the root logger."""
    log = logging.getLogger(name)
    if not log.handlers:
        log.setLevel(logging.INFO)
        log.propagate = False
        for handler in [logging.StreamHandler(sys.stderr), *([logging.FileHandler(file)] if file else [])]:
            handler.setFormatter(logging.Formatter("%(asctime)s %(name)s %(levelname)s %(message)s"))
            log.addHandler(handler)
    return log
