"""Protocol and host of URLs as column expressions.

The host is what stands between ``://`` and the next ``/``, ``?`` or ``#``, in lower case, up to its first colon, without one
leading ``www.``. It is no registered domain: ``blog.a.com`` stays as it is. URLs that don't begin with one of four schemes in
lower case get ``http://``. Everything stays JVM-side, so column pruning and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMES = ("http", "https", "ftp", "ftps")
_HEX = "[0-9a-fA-F]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"


def _ipv6_pattern() -> str:
    """Eight groups, or fewer with one ``::`` among them; the last two may be an IPv4 address; then a zone."""
    v4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"

    def groups(n: int) -> list[str]:
        """Exactly n groups, colons between."""
        plain = [] if n == 0 else [":".join([_HEX] * n)]
        return [""] if n == 0 else plain + ([":".join([_HEX] * (n - 2) + [v4])] if n >= 2 else [])

    forms = groups(8)
    for left in range(8):
        head = ":".join([_HEX] * left)
        tails = [t for n in range(8 - left) for t in groups(n)]
        forms.append(f"{head}::(?:{'|'.join(reversed(tails))})")
    return f"(?:{'|'.join(forms)})(?:%.+)?"


IPV6 = _ipv6_pattern()


def _with_scheme(url: Column) -> Column:
    given = url.rlike("^(?:" + "|".join(SCHEMES) + ")://")
    return F.regexp_replace(F.when(given, url).otherwise(F.concat(F.lit("http://"), url)), r"[\t\r\n]", "")


def _location(url: Column) -> Column:
    return F.lower(F.regexp_extract(_with_scheme(url), "^[a-z]+://([^/?#]*)", 1))


def _readable(location: Column) -> Column:
    """False for brackets that are not a pair, or whose content is no IPv6 address."""
    opened, closed = location.contains("["), location.contains("]")
    inside = F.regexp_extract(location, r"\[([^\]]*)\]?", 1)
    return (~opened & ~closed) | (opened & closed & inside.rlike(f"^{IPV6}$"))


def has_url(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def domain(url: Column) -> Column:
    """Null where there is no URL or it cannot be read; empty where it has no host."""
    at = _location(url)
    host = F.regexp_replace(F.substring_index(at, ":", 1), r"^www\.", "")
    return F.when(has_url(url) & _readable(at), host)


def protocol(url: Column) -> Column:
    return F.when(has_url(url) & _readable(_location(url)), F.regexp_extract(_with_scheme(url), "^([a-z]+)://", 1))


def domain_dir(d: Column) -> Column:
    """Name of a domain's folder. ``a.b_c`` and ``a_b.c`` share one, so writers partition by the domain itself."""
    return F.replace(d, F.lit("."), F.lit("_"))


#: The same expressions for DuckDB.
SQL_WITH_SCHEME = r"regexp_replace(case when regexp_matches({0}, '^(?:http|https|ftp|ftps)://') then {0} else 'http://' || {0} end, '[\t\r\n]', '', 'g')"
SQL_DOMAIN = rf"regexp_replace(split_part(lower(regexp_extract({SQL_WITH_SCHEME}, '^[a-z]+://([^/?#]*)', 1)), ':', 1), '^www\.', '')"
SQL_PROTOCOL = f"regexp_extract({SQL_WITH_SCHEME}, '^([a-z]+)://', 1)"
