"""Plug-ins that discover documents from stored pages.

A plug-in is a function (seed_url, html) -> iterable of dicts with page_url,
pdf_url and metadata. It is registered for a host (``www.`` included) and runs
as a table function over Arrow batches; hosts without one take the fallback.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls as U
from corpusloom.operators.html import read_page

DISCOVERED = "seed_url string, page_url string, pdf_url string, title string, source string"
Plugin = Callable[[str, str], Iterable[dict]]


def generic(seed_url: str, page: str) -> Iterator[dict]:
    """Links that look like PDFs, with the text of their anchors."""
    for href, anchor in read_page(page).links:
        url = urljoin(seed_url, href).split("#", 1)[0]
        if re.search(U.PDF_HINTS, url.lower()):
            yield {"page_url": seed_url, "pdf_url": url, "title": anchor}


class Plugins:
    """Functions by host; travels to the workers with the query that uses it."""

    def __init__(self, fallback: Plugin | None = generic):
        self.by_host: dict[str, tuple[str, Plugin]] = {}
        self.fallback = fallback

    def register(self, host: str, name: str, plugin: Plugin) -> Plugins:
        self.by_host[host.lower().removeprefix("www.")] = (name, plugin)
        return self

    def register_many(self, hosts: Iterable[str], name: str, plugin: Plugin) -> Plugins:
        for h in hosts:
            self.register(h, name, plugin)
        return self

    def pick(self, host: str) -> tuple[str, Plugin] | None:
        return self.by_host.get(host) or (("generic", self.fallback) if self.fallback else None)

    def discover(self, pages: DataFrame) -> DataFrame:
        """DISCOVERED rows of pages (seed_url, html); a plug-in that fails gives none for its page."""
        table, fallback = dict(self.by_host), self.fallback

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for seed, page, host in zip(frame["seed_url"], frame["html"], frame["host"]):
                    name, plugin = table.get(host) or ("generic", fallback)
                    if plugin is None or not seed:
                        continue
                    try:
                        found = list(plugin(seed, page or ""))
                    except Exception:
                        continue
                    rows += [(seed, f.get("page_url"), f.get("pdf_url"), f.get("title"), name) for f in found]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in DISCOVERED.split(", ")], dtype=object)

        return pages.select("seed_url", "html", U.host(F.col("seed_url")).alias("host")).mapInPandas(run, DISCOVERED)
