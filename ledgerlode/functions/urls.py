"""URL rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The hosts that filings are read from.
HOSTS = ("data.sec.gov", "www.sec.gov")
UNQUOTES = 5
#: Fixed value: names that are safe at a glance, as nearly all are.
PLAIN_NAME = r"\A[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*\z"


def unquoted(value: Column, times: int = UNQUOTES) -> Column:
    """Percent-escapes of ASCII characters that decide whether a path is safe, decoded again and again."""
    plain = value
    marks = {"%": "25", ".": "2[eE]", "/": "2[fF]", "\\\\": "5[cC]", "\x00": "(?:[01][0-9a-fA-F]|7[fF])"}
    for _ in range(times):
        for mark, code in sorted(marks.items(), key=lambda x: x[0] == "%"):  # the sign itself last, so a step decodes one level
            value = F.regexp_replace(value, f"%{code}", mark)
    return F.when(plain.contains("%"), value).otherwise(plain)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def url_problem(url: Column, hosts: tuple[str, ...] = HOSTS) -> Column:
    """Why a URL may not be fetched, or ``ok``; the first rule that fails."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    host = F.lower(F.regexp_extract(rest, r"^(?:[^@]*@)?([^:]*)", 1))
    port = F.regexp_extract(rest, r":([^:@]*)$", 1)
    return let(unquoted(path), lambda seen: _problem(url, rest, host, port, seen, hosts))


def _problem(url: Column, rest: Column, host: Column, port: Column, seen: Column, hosts: tuple[str, ...]) -> Column:
    return (
        F.when(url.isNull() | (url == "") | url.rlike(r"[\x00-\x1f\x7f]"), "control_character")
        .when(url.contains("?") | url.contains("#"), "query_or_fragment")
        .when(url.rlike("%(?![0-9a-fA-F]{2})"), "percent")
        .when(~url.rlike("(?i)^https://"), "scheme")
        .when(~host.isin(*hosts), "host")
        .when(rest.contains("@"), "credentials")
        .when(~port.isin("", "443"), "port")
        .when(unquoted(seen, 1) != seen, "nested_escapes")
        .when(seen.rlike(r"[\x00-\x1f\x7f\\]|^//|(^|/)\.{1,2}(/|$)"), "traversal")
        .otherwise("ok")
    )


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def safe_filename(name: Column) -> Column:
    """The name where it is a plain basename without two dots in a row, even after decoding; otherwise null."""
    return F.when(name.rlike(PLAIN_NAME) | let(unquoted(name), lambda seen: _plain(name, seen)), name)


def _plain(name: Column, seen: Column) -> Column:
    bad = name.rlike(r"[\x00-\x1f\x7f]|%(?![0-9a-fA-F]{2})") | (unquoted(seen, 1) != seen)
    plain = lambda x: ~x.rlike(r"[/\\\x00-\x1f\x7f]|\.\.") & (x != ".")
    return (name != "") & ~bad & plain(name) & plain(seen)


def encoded(name: Column) -> Column:
    """A file's name with all but letters, digits and ``-._~`` as percent-escapes."""
    plus = F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(plus, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def document_url(cik: Column, accession: Column, name: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), F.regexp_replace(cik, "^0+(?=.)", ""), F.lit("/"), F.replace(accession, F.lit("-")), F.lit("/"), encoded(name))
