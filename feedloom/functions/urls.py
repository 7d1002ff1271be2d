"""URL expressions: Column in, Column out, all inside the JVM.

Patterns are written so that Java and RE2 read them alike: no look-around, no
alternation inside a loop (a Java stack overflow on long runs), and whitespace spelled
out because each engine has its own idea of ``\\s``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space, the URL alphabet, the hosts and the wrapper.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = r"https?://[A-Za-z0-9$%&'/.+\-]+"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
OWN_HOSTS = ("twitter.com", "api.twitter.com")
SHORT_HOSTS = ("bit.ly", "buff.ly", "t.co")
WRAPPER = r"www\.google[^\n]com/amp/s/"
URL_NOISE = ',)"!'
RIGHT_QUOTE = "’"


def extract_urls(text: Column) -> Column:
    """All URLs of a text, in order; a URL ends at the first character outside its alphabet."""
    return F.regexp_extract_all(text, F.lit(URL), F.lit(0))


def clean_url(url: Column) -> Column:
    """Delete punctuation that clings to a URL and cut at a typographic apostrophe."""
    return F.substring_index(F.translate(url, URL_NOISE, ""), RIGHT_QUOTE, 1)


def link_patterns(hosts: Sequence[str]) -> list[str]:
    """One pattern per host and scheme, https first; order matters for nested links."""
    return [f"{scheme}://{re.escape(host)}/[^{SPACE}]+" for host in hosts for scheme in ("https", "http")]


def _delete(text: Column, patterns: Sequence[str]) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return text


def strip_host_urls(text: Column, hosts: Sequence[str] = OWN_HOSTS) -> Column:
    """Remove links to the given hosts."""
    return _delete(text, link_patterns(hosts))


def strip_short_links(text: Column, hosts: Sequence[str] = SHORT_HOSTS) -> Column:
    """Remove shortened links, then unwrap cached-page links."""
    return _delete(text, [*link_patterns(hosts), WRAPPER])


def url_domain(url: Column) -> Column:
    """Authority without ``www.``; the first label goes when over two remain and the last is ``com``."""
    host = F.replace(F.regexp_extract(url, AUTHORITY, 1), F.lit("www."), F.lit(""))
    return F.when(host.rlike(r"^[^.]*\.(?s:.*)\.com\z"), F.regexp_extract(host, r"^[^.]*\.((?s:.*))\z", 1)).otherwise(host)


def drop_empty(values: Column) -> Column:
    return F.filter(values, lambda v: v != "")


def url_domains(text: Column) -> Column:
    """Domains of the links in a text, after own-host and shortened links are gone.

    Shortened links are stripped twice: unwrapping can uncover another one.
    """
    stripped = strip_short_links(strip_short_links(strip_host_urls(text)))
    return drop_empty(F.transform(extract_urls(stripped), url_domain))


def news_flag(text: Column, news_domains: Sequence[str]) -> Column:
    """1 when any linked domain is on the list, else 0. NULL text has no links."""
    known = F.array(*[F.lit(d) for d in news_domains]) if news_domains else F.array().cast("array<string>")
    return F.coalesce(F.arrays_overlap(url_domains(text), known), F.lit(False)).cast("int")
