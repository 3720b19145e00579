"""User-agent text to browser and operating system.

The rules are tried in order and the first hit wins, so a browser that carries another
one's token (most carry Chrome's or Safari's) stands before it. A rule costs one
substring test; the version is read once, for the rule that hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.schemas import AGENT_COLUMNS

UNKNOWN = "unknown"

# (name, text that identifies it, text right before its version)
BROWSER_RULES = (
    ("Sogou web spider", "Sogou web spider", "Sogou web spider/"),
    ("Baiduspider", "Baiduspider", "Baiduspider/"),
    ("Googlebot", "Googlebot", "Googlebot/"),
    ("bingbot", "bingbot", "bingbot/"),
    ("Crawler", "spider", "spider/"),
    ("Crawler", "Spider", "Spider/"),
    ("Crawler", "bot", "bot/"),
    ("Crawler", "Bot", "Bot/"),
    ("Go-http-client", "Go-http-client", "Go-http-client/"),
    ("curl", "curl/", "curl/"),
    ("Wget", "Wget/", "Wget/"),
    ("python-requests", "python-requests", "python-requests/"),
    ("okhttp", "okhttp", "okhttp/"),
    ("Apache-HttpClient", "Apache-HttpClient", "Apache-HttpClient/"),
    ("swcd", "swcd", "swcd/"),
    ("WeChat", "MicroMessenger", "MicroMessenger/"),
    ("Sogou Explorer", "MetaSr", " SE "),
    ("QQBrowser", "QQBrowser", "QQBrowser/"),
    ("UC Browser", "UCBrowser", "UCBrowser/"),
    ("Maxthon", "Maxthon", "Maxthon/"),
    ("Edge", "Edg/", "Edg/"),
    ("Edge", "Edge/", "Edge/"),
    ("Edge", "EdgA/", "EdgA/"),
    ("Edge", "EdgiOS/", "EdgiOS/"),
    ("Opera", "OPR/", "OPR/"),
    ("Opera", "Opera", "Opera/"),
    ("Firefox", "Firefox/", "Firefox/"),
    ("Chrome", "Chrome/", "Chrome/"),
    ("Chrome", "CriOS/", "CriOS/"),
    ("Internet Explorer", "MSIE ", "MSIE "),
    ("Internet Explorer", "Trident/", "rv:"),
    ("Safari", "Safari/", "Version/"),
    ("CFNetwork", "CFNetwork/", "CFNetwork/"),
)

OS_RULES = (
    ("Windows Phone", "Windows Phone", "Windows Phone "),
    ("Windows", "Windows NT", "Windows NT "),
    ("Windows", "Windows", "Windows "),
    ("Android", "Android", "Android "),
    ("iOS", "iPhone OS", "iPhone OS "),
    ("iOS", "iPad", "CPU OS "),
    ("Mac OS X", "Mac OS X", "Mac OS X "),
    ("Darwin", "Darwin/", "Darwin/"),
    ("Linux", "Linux", "Linux "),
)

Rules = tuple[tuple[str, str, str], ...]


def _rule_number(ua: str, rules: Rules) -> str:
    """SQL: position of the first rule that hits, or null."""
    hits = " ".join(f"WHEN contains({ua}, '{token}') THEN {i}" for i, (_, token, _) in enumerate(rules))
    return f"CASE {hits} END"


def _listed(rules: Rules, field: int, number: str) -> str:
    values = ", ".join(f"'{rule[field]}'" for rule in rules)
    return f"get(array({values}), {number})"


def _version(ua: str, before: str) -> str:
    """SQL: word characters and dots that follow ``before``."""
    rest = f"substring({ua}, locate({before}, {ua}) + length({before}))"
    found = f"regexp_extract({rest}, r'^[\\w.]+', 0)"
    return f"CASE WHEN contains({ua}, {before}) AND {found} <> '' THEN {found} ELSE '{UNKNOWN}' END"


def with_agent(rows: DataFrame, ua: str = "ua") -> DataFrame:
    """Add browsername, browserversion, osname and osversion, read from column ``ua``.

    Small steps instead of one expression per column: one chain that also cuts the
    versions grows past what the JVM is willing to compile.
    """
    numbered = rows.selectExpr(
        "*", f"{_rule_number(ua, BROWSER_RULES)} AS _b", f"{_rule_number(ua, OS_RULES)} AS _o"
    )
    named = numbered.selectExpr(
        "*",
        f"coalesce({_listed(BROWSER_RULES, 0, '_b')}, '{UNKNOWN}') AS browsername",
        f"{_listed(BROWSER_RULES, 2, '_b')} AS _bv",
        f"coalesce({_listed(OS_RULES, 0, '_o')}, '{UNKNOWN}') AS osname",
        f"{_listed(OS_RULES, 2, '_o')} AS _ov",
    )
    versioned = named.selectExpr(
        "*", f"{_version(ua, '_bv')} AS browserversion", f"{_version(ua, '_ov')} AS osversion"
    )
    return versioned.select(*rows.columns, *AGENT_COLUMNS)
