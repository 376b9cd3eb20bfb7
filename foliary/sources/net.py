"""Network policy, robots and sitemaps. Fetching itself is injected: nothing here opens a connection."""

from __future__ import annotations

import ipaddress
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The sitemap namespace, and hosts and addresses of cloud metadata services.
SITEMAP = "{http://www.sitemaps.org/schemas/sitemap/0.9}"
METADATA_HOSTS = frozenset(("metadata.google.internal", "metadata.aws.amazon.com", "metadata"))
METADATA_IPS = frozenset(("169.254.169.254", "169.254.170.2", "fd00:ec2::254"))
MAX_REDIRECTS = 5


class PolicyError(ValueError):
    """A URL that policy forbids to fetch."""


def private_host(host: str) -> bool:
    try:
        a = ipaddress.ip_address(host)
    except ValueError:
        return host.lower() == "localhost"
    return a.is_loopback or a.is_private or a.is_link_local


def crawlable(url: str) -> bool:
    parts = urlsplit(url)
    return parts.scheme in ("http", "https") and bool(parts.hostname) and not private_host(parts.hostname)


def unsafe_address(address: str) -> bool:
    if address in METADATA_IPS:
        return True
    try:
        a = ipaddress.ip_address(address)
    except ValueError:
        return True
    return a.is_private or a.is_loopback or a.is_link_local or a.is_multicast or a.is_reserved or a.is_unspecified


def check_sitemap_url(url: str, resolve: Callable[[str], list[str]]) -> str:
    """The URL, if its scheme, host and every address that ``resolve`` gives are safe; fails closed."""
    parts = urlsplit(url or "")
    host = (parts.hostname or "").lower()
    if parts.scheme.lower() not in ("http", "https") or not host:
        raise PolicyError(f"not an http(s) URL with a host: {url!r}")
    if host in METADATA_HOSTS:
        raise PolicyError(f"{host!r} is a metadata service")
    try:
        ipaddress.ip_address(host)
        found = [host]
    except ValueError:
        try:
            found = resolve(host)
        except OSError as e:
            raise PolicyError(f"{host!r} does not resolve: {e}") from e
    if not found or any(map(unsafe_address, found)):
        raise PolicyError(f"{host!r} has no or an unsafe address")
    return url


def robots_allow(robots: str | None, agent: str, url: str) -> bool:
    if not robots:
        return True
    p = RobotFileParser()
    p.parse(robots.splitlines())
    return p.can_fetch(agent, url)


def robots_allowed(robots: Column, url: Column, agent: str) -> Column:
    """Whether rules let the agent fetch an address. In Arrow batches; equal rules are read once a batch."""

    @F.pandas_udf(T.BooleanType())
    def allowed(texts: pd.Series, urls: pd.Series) -> pd.Series:
        read: dict[str, RobotFileParser] = {}
        for t in texts.dropna().unique():
            read[t] = RobotFileParser()
            read[t].parse(t.splitlines())
        return pd.Series([not t or read[t].can_fetch(agent, u) for t, u in zip(texts, urls, strict=True)])

    return allowed(robots, url)


def robots_sitemaps(robots: str) -> list[str]:
    found = (re.match(r"(?i)\s*sitemap\s*:\s*(\S.*?)\s*$", line) for line in robots.splitlines())
    return [m[1] for m in found if m]


def _sitemap_root(xml: str, name: str) -> ET.Element:
    if "<!DOCTYPE" in xml or "<!ENTITY" in xml:
        raise ValueError("declarations are not allowed in a sitemap")
    try:
        root = ET.fromstring(xml)
    except ET.ParseError as e:
        raise ValueError(f"not XML: {e}") from e
    if root.tag != SITEMAP + name:
        raise ValueError(f"root is {root.tag}, not {name}")
    return root


def sitemap_urls(xml: str) -> list[tuple[str, str | None]]:
    """(location, last change) of a URL set."""
    out = []
    for u in _sitemap_root(xml, "urlset").iter(SITEMAP + "url"):
        loc, mod = u.findtext(SITEMAP + "loc", "").strip(), u.findtext(SITEMAP + "lastmod")
        if loc:
            out.append((loc, mod.strip() if mod is not None else None))
    return out


def sitemap_children(xml: str) -> list[str]:
    """Locations of the sitemaps that an index names."""
    found = (s.findtext(SITEMAP + "loc", "").strip() for s in _sitemap_root(xml, "sitemapindex").iter(SITEMAP + "sitemap"))
    return [x for x in found if x]


def read_sitemaps(files: DataFrame, key: str, xml: str = "xml") -> DataFrame:
    """(key, kind, loc, lastmod, error): locations of URL sets ("url") and of indexes ("sitemap"); a file that is neither gives its reason."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch[key], batch[xml], strict=True):
                try:
                    if "<sitemapindex" in text:
                        rows += [(k, "sitemap", loc, None, None) for loc in sitemap_children(text)]
                    else:
                        rows += [(k, "url", loc, mod, None) for loc, mod in sitemap_urls(text)]
                except ValueError as e:
                    rows.append((k, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=[key, "kind", "loc", "lastmod", "error"]).astype(object).where(lambda d: d.notna(), None)

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, xml).mapInPandas(run, f"`{key}` {kind}, kind string, loc string, lastmod string, error string")


@F.pandas_udf(T.BooleanType())
def sitemap_safe(url: pd.Series, addresses: pd.Series) -> pd.Series:
    """Whether a sitemap may be fetched, given the addresses that its host resolves to (null: it does not)."""

    def one(u, found) -> bool:
        def resolve(_: str) -> list[str]:
            if found is None:
                raise OSError("no address")
            return list(found)

        try:
            return bool(check_sitemap_url(u, resolve))
        except PolicyError:
            return False

    return pd.Series([one(u, a) for u, a in zip(url, addresses, strict=True)])


@dataclass(frozen=True)
class Response:
    url: str
    status: int
    content_type: str | None
    body: bytes
    location: str | None = None


def fetch(url: str, get: Callable[[str], Response], most: int = MAX_REDIRECTS) -> tuple[str, Response]:
    """Follow redirects with ``get``; every hop is checked against policy. Returns the decoded body and the last response."""
    for _ in range(most + 1):
        if not crawlable(url):
            raise PolicyError(f"policy forbids {url!r}")
        r = get(url)
        if not (300 <= r.status < 400 and r.location):
            charset = re.search(r"charset=[\"']?([\w-]+)", r.content_type or "")
            try:
                return r.body.decode(charset[1] if charset else "utf-8", "replace"), r
            except LookupError:
                return r.body.decode("utf-8", "replace"), r
        url = urljoin(url, r.location)
    raise PolicyError(f"more than {most} redirects")
