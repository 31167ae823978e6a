"""Checks on file addresses before anything is fetched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchloom.contract import ALLOWED_SCHEMES

# fixed values: IPv4 ranges that must never be fetched, as (first octets, prefix bits)
BLOCKED_V4 = [
    ("0.0.0.0", 32),
    ("10.0.0.0", 8),
    ("100.64.0.0", 10),
    ("127.0.0.0", 8),
    ("169.254.0.0", 16),
    ("172.16.0.0", 12),
    ("192.168.0.0", 16),
    ("224.0.0.0", 24),
]
V4_TEXT = r"^(0|[1-9]\d{0,2})\.(0|[1-9]\d{0,2})\.(0|[1-9]\d{0,2})\.(0|[1-9]\d{0,2})$"
# fixed values: IPv6 loopback and unspecified; fe80::/10, fc00::/7, ff01/ff02 multicast
BLOCKED_V6 = r"(?i)^(::1?|(0{1,4}:){7}0{0,3}[01]|fe[89ab][0-9a-f]:.*|f[cd][0-9a-f]{2}:.*|ff[0-9a-f][12]:.*)$"
V6_TEXT = r"(?i)^[0-9a-f:.]*:[0-9a-f:.]*$"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def _authority(url: Column) -> Column:
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(authority, r"^.*@", "")


def url_host(url: Column) -> Column:
    """Host without user, port or brackets, lower case; empty when there is none."""
    bare = F.regexp_replace(_authority(url), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(bare, r"^\[(.*)\]$", "$1"))


def url_allowed(url: Column, hosts: list[str], schemes: list[str] | None = None) -> Column:
    """Scheme and host on the allow list; an address that does not parse is refused."""
    schemes = [s.lower() for s in (schemes or ALLOWED_SCHEMES)]
    hosts = [h.strip().lower() for h in hosts]
    text = F.coalesce(url, F.lit(""))
    host = url_host(text)
    parses = _authority(text).rlike(r"^(\[[^\]]*\]|[^:\[\] ]*)(:[0-9]*)?$") & ~text.rlike(r"[\x00-\x1f\x7f]")
    return url_scheme(text).isin(schemes) & parses & (host != "") & host.isin(hosts)


def ip_blocked(ip: Column) -> Column:
    """Private, loopback, link-local, shared or unspecified; texts that are no address too."""
    text = F.coalesce(ip, F.lit(""))
    mapped = F.regexp_replace(text, r"(?i)^::ffff:(?=\d+\.)", "")
    octets = [F.regexp_extract(mapped, V4_TEXT, i).try_cast("bigint") for i in range(1, 5)]
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    in_range = F.lit(False)
    for base, bits in BLOCKED_V4:
        a, b, c, d = (int(x) for x in base.split("."))
        low = a * 16777216 + b * 65536 + c * 256 + d
        in_range = in_range | number.between(low, low + (1 << (32 - bits)) - 1)
    valid_v4 = F.greatest(*octets) <= 255
    return (
        F.when(mapped.rlike(V4_TEXT), ~F.coalesce(valid_v4, F.lit(False)) | in_range)
        .when(mapped.rlike(V6_TEXT), mapped.rlike(BLOCKED_V6))
        .otherwise(F.lit(True))
    )
