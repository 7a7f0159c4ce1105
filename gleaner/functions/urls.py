"""URL parts and the checks a host name has to pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_all

# The schemes a standard Java runtime has handlers for.
KNOWN_SCHEMES = ("http", "https", "ftp", "file", "jar", "mailto")

SCHEME = r"^([a-z][a-z0-9+.\-]*):"
AUTHORITY = r"^[a-z][a-z0-9+.\-]*://([^/?#]*)"

# Host-name syntax: labels of 1 to 63 characters, ASCII ones limited to letters, digits, - and _,
# neither starting nor ending with - or _; the last label must not start with a digit.
_EDGE = r"[a-z0-9\x{80}-\x{10FFFF}]"
_LAST_EDGE = r"[a-z\x{80}-\x{10FFFF}]"
_INNER = r"[a-z0-9_\-\x{80}-\x{10FFFF}]"
HOST_SYNTAX = (
    rf"\A(?:{_EDGE}(?:{_INNER}{{0,61}}{_EDGE})?\.)*{_LAST_EDGE}(?:{_INNER}{{0,61}}{_EDGE})?\z"
)
MAX_HOST_LENGTH = 253
MAX_LABELS = 127

# Fixed value: a leading label group that may be dropped in front of a registrable domain.
WWW_LABEL = r"\Awww[A-Za-z0-9_]*\z"


def normal_url(url: Column) -> Column:
    return F.regexp_replace(trim_all(F.lower(url)), r"^url:", "")


def scheme(url: Column) -> Column:
    """Scheme of a normalised URL, or the empty string."""
    return F.regexp_extract(url, SCHEME, 1)


def host_and_port(url: Column) -> Column:
    """Authority of a normalised URL without user information; empty when it is ambiguous."""
    authority = F.regexp_extract(url, AUTHORITY, 1)
    ambiguous = authority.rlike("@.*@")
    return F.when(ambiguous, "").otherwise(F.substring_index(authority, "@", -1))


def host_of(hostport: Column) -> Column:
    bracketed = F.regexp_extract(hostport, r"^(\[[^\]]*\]?)", 1)
    return F.when(hostport.startswith("["), bracketed).otherwise(
        F.substring_index(hostport, ":", 1)
    )


def port_is_valid(hostport: Column) -> Column:
    return ~hostport.rlike(r"^[^\[:]*:") | hostport.rlike(r"^[^:]*:[0-9]{0,9}\z")


def url_host(url: Column) -> Column:
    return host_of(host_and_port(normal_url(url)))


def bare_host(host: Column) -> Column:
    """Host without one trailing dot."""
    return F.regexp_replace(host, r"\.\z", "")


def label_count(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def host_is_legal(bare: Column) -> Column:
    return (
        (F.length(bare) <= MAX_HOST_LENGTH)
        & (label_count(bare) <= MAX_LABELS)
        & bare.rlike(HOST_SYNTAX)
    )


def domain_offset_is_bad(host: Column, domain: Column) -> Column:
    """The domain occurs at the very start of a longer host, so no label precedes it."""
    return (host != domain) & (F.instr(host, domain) <= 2)


def canonical_host(host: Column, domain: Column) -> Column:
    """The domain itself when only a www-like label precedes its first occurrence."""
    prefix = host.substr(F.lit(1), F.instr(host, domain) - 2)
    return F.when((host != domain) & prefix.rlike(WWW_LABEL), domain).otherwise(host)
