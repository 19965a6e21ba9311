"""Fetching pages, outside of Spark: an allow-list, pauses between requests, retries, and the chain of next links."""

from __future__ import annotations

import hashlib
import os
import re
import time
import urllib.request
from collections.abc import Callable
from html import unescape
from urllib.parse import urldefrag, urljoin, urlsplit

AGENT = "passageworks/1.0 (+offline analytics; one request a second)"


def _get(url: str) -> bytes:
    request = urllib.request.Request(url, headers={"User-Agent": AGENT})
    with urllib.request.urlopen(request, timeout=60) as r:  # noqa: S310
        return r.read()


class Fetcher:
    """get(url) with at least `pause` seconds between requests; failures are tried again after 1, 2, 4, ... seconds, and the last is raised."""

    def __init__(self, get: Callable[[str], bytes] = _get, denied: tuple[str, ...] = (), pause: float = 1.0, attempts: int = 3, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self._get, self.denied, self.pause, self.attempts, self._clock, self._sleep = get, denied, pause, attempts, clock, sleep
        self._last: float | None = None

    def get(self, url: str) -> bytes:
        if any(d in url for d in self.denied):
            raise ValueError(f"{url} is not allowed")
        for n in range(self.attempts):
            if self._last is not None and (wait := self._last + self.pause - self._clock()) > 0:
                self._sleep(wait)
            self._last = self._clock()
            try:
                return self._get(url)
            except OSError:
                if n + 1 == self.attempts:
                    raise
                self._sleep(2.0**n)
        raise ValueError("attempts must be positive")

    def download(self, url: str, path: str) -> str:
        """Save a file once; returns its SHA-256. A file that is there is not fetched again."""
        if not os.path.exists(path):
            data = self.get(url)
            os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
            with open(path + ".part", "wb") as f:
                f.write(data)
            os.replace(path + ".part", path)
        digest = hashlib.sha256()
        with open(path, "rb") as f:
            while part := f.read(1 << 16):
                digest.update(part)
        return digest.hexdigest()


def collect(fetcher: Fetcher, seeds: list[str], base: str, folder: str, limit: int | None = None) -> list[dict]:
    """Manifest rows of the pages from each seed over next links below the base, in order; a page that was seen ends its chain. Pages are saved in
    the folder, and those that are there are not fetched again."""
    seen: set[str] = set()
    rows: list[dict] = []
    for seed in seeds:
        url: str | None = seed
        while url and url.startswith(base) and url not in seen and (limit is None or len(rows) < limit):
            seen.add(url)
            slug = urlsplit(url).path.rstrip("/").rpartition("/")[2] or "index.html"
            path = os.path.join(folder, slug)
            digest = fetcher.download(url, path)
            with open(path, encoding="utf-8", errors="replace") as f:
                html = f.read()
            title = re.search(r"(?is)<title[^>]*>(.*?)</title>", html)
            rows.append({"slug": slug, "url": url, "title": unescape(title[1]).strip() if title else "", "sha256": digest, "ordinal": len(rows), "bytes": os.path.getsize(path), "parent_slug": _slug(url, html, "u")})
            to = _link(url, html, "n")
            url = to
    return rows


def _link(url: str, html: str, key: str) -> str | None:
    tag = re.search(rf"(?is)<a\b[^>]*\baccesskey=[\"']{key}[\"'][^>]*>", html)
    href = tag and re.search(r"(?is)\bhref=[\"']([^\"']+)", tag[0])
    return urldefrag(urljoin(url, unescape(href[1])))[0] if href else None


def _slug(url: str, html: str, key: str) -> str | None:
    to = _link(url, html, key)
    return None if to is None else urlsplit(to).path.rstrip("/").rpartition("/")[2] or "index.html"
