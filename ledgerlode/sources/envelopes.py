"""Bytes of wrapped filing documents: envelopes around one document, full submissions, encodings."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: The header lines that an envelope may have, and the lengths of a value and of all together.
HEADERS = frozenset(("type", "sequence", "filename", "description", "mime", "content-type", "size", "md5"))
VALUE_LIMIT, HEADER_LIMIT = 4096, 8192
#: Byte order marks, the longer ones first.
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
#: Where a page names its charset, and how far it is looked for.
CHARSET, CHARSET_WITHIN = re.compile(rb"(?is)<meta\b[^>]*(?:charset\s*=\s*[\"']?)([a-z0-9._-]+)"), 8192
#: Marks of a payload's kind, as an envelope reports it.
HTML_DOCUMENT = re.compile(r"(?i)<\s*(?:!doctype\s+html\b|html\b|head\b|body\b)")
HTML_START = re.compile(r"(?i)<\s*(?:!doctype\s+html|html|head|body|table|p|div|h[1-6])\b")
SGML_PAGE, SGML_TABLE, SGML_CELL = (re.compile(rf"(?im)^\s*<{x}>\s*$") for x in ("PAGE", "TABLE", "(?:S|C)"))
PROBE = 8192
PDF_TEXT_WITHIN = 16384

_SPACE = b" \t\r\n\v\f"
_HEADER = re.compile(r"\s*<([A-Za-z][A-Za-z0-9_-]*)>(.*)")


class EnvelopeError(ValueError):
    """Bytes that begin as an envelope and aren't a sound one."""


@dataclass(frozen=True)
class Envelope:
    payload: bytes
    headers: dict[str, str]
    encoding: str
    kind: str
    start: int
    end: int


def html_encoding(raw: bytes) -> str:
    """By byte order mark, then by a charset that the page names, else UTF-8."""
    for mark, name in MARKS:
        if raw.startswith(mark):
            return "utf-8-sig" if name == "utf-8" else name
    named = CHARSET.search(raw[:CHARSET_WITHIN])
    return named[1].decode("ascii").lower() if named else "utf-8"


def payload_encoding(payload: bytes, fallback: str | None = None) -> str:
    """The payload's own encoding; the wrapper's only where there is no payload."""
    return html_encoding(payload) if payload else fallback or "utf-8"


def decoded(raw: bytes, encoding: str) -> str:
    """Text of bytes, with what can't be decoded replaced; an unknown encoding counts as UTF-8."""
    try:
        return raw.decode(encoding, "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def envelope_encoding(raw: bytes) -> tuple[str, int] | None:
    """The encoding of a leading envelope and the length of its byte order mark; None where none begins."""
    name, skip = next(((n, len(m)) for m, n in MARKS if raw.startswith(m)), (None, 0))
    if name is None:
        return ("utf-8", 0) if raw.lstrip(_SPACE)[:9].upper() == b"<DOCUMENT" else None
    sample = raw[skip : skip + 1024].decode(name, "ignore")
    return (name, skip) if sample.lstrip().casefold().startswith("<document") else None


def probe_kind(text: str) -> str:
    """html or legacy_text by the beginning of a payload."""
    if HTML_DOCUMENT.search(text):
        return "html"
    legacy = SGML_PAGE.search(text) or SGML_TABLE.search(text) and SGML_CELL.search(text)
    return "html" if not legacy and HTML_START.search(text) else "legacy_text"


def _header(name: str, value: str, held: dict[str, str]) -> None:
    """Adds one header; raises for a name that isn't allowed or comes again, and for values over the limits."""
    if name not in HEADERS:
        raise EnvelopeError("unsupported header")
    if name in held:
        raise EnvelopeError("repeated header")
    held[name] = value
    if len(value) > VALUE_LIMIT or sum(len(k) + len(v) for k, v in held.items()) > HEADER_LIMIT:
        raise EnvelopeError("header too long")


def unwrap(raw: bytes) -> Envelope | None:
    """The document inside an envelope; None for bytes that don't begin as one.

    An envelope is one opening line, header lines with a type, a text line, the payload, and
    both closing lines with nothing but white space after and between them.
    """
    known = envelope_encoding(raw)
    if known is None:
        return None
    encoding, skip = known
    try:
        text = raw[skip:].decode(encoding)
    except UnicodeDecodeError:
        if encoding != "utf-8":
            raise EnvelopeError("undecodable") from None
        encoding = "cp1252"
        try:
            text = raw[skip:].decode(encoding)
        except UnicodeDecodeError:
            raise EnvelopeError("undecodable") from None
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    bare = [x.strip() for x in lines]
    filled = [k for k, x in enumerate(bare) if x]
    if not filled or bare[filled[0]].casefold() != "<document>":
        raise EnvelopeError("no opening line")
    headers: dict[str, str] = {}
    body = None
    for k in filled[1:]:
        if bare[k].casefold() == "<text>":
            body = k + 1
            break
        m = _HEADER.fullmatch(lines[k].rstrip("\r\n"))
        if not m:
            raise EnvelopeError("unknown line before the text")
        _header(m[1].casefold(), m[2].strip(), headers)
    if body is None:
        raise EnvelopeError("no text line")
    if not headers.get("type"):
        raise EnvelopeError("no type")
    tail = [k for k in filled if k >= body]
    low = [bare[k].casefold() for k in tail]
    ends = [i for i in range(len(low) - 1) if low[i] == "</text>" and low[i + 1] == "</document>"]
    if ends[-1:] != [len(low) - 2]:
        raise EnvelopeError("content after the closing lines" if ends else "no closing lines")
    if len(ends) > 1:
        raise EnvelopeError("content after the closing lines")
    stop = tail[ends[0]]
    size = lambda some: len("".join(some).encode(encoding))
    start = skip + size(lines[:body])
    end = start + size(lines[body:stop])
    payload = raw[start:end]
    if not payload.decode(encoding).strip():
        raise EnvelopeError("empty text")
    probe, n = [], 0
    for x in lines[body:]:
        if n >= PROBE:
            break
        if x.strip().casefold() != "</text>":
            probe.append(x)
            n += len(x)
    return Envelope(payload, headers, encoding, probe_kind("".join(probe)), start, end)


def is_pdf(raw: bytes) -> bool:
    """Whether the bytes are a sound envelope around a PDF, whose own bytes are text of no encoding."""
    skip = 3 if raw.startswith(MARKS[0][0]) else 0
    if raw[skip:].lstrip(_SPACE)[:10].lower() != b"<document>":
        return False
    opened = re.search(rb"(?im)^[ \t]*<TEXT>[ \t]*(?:\r\n|\r|\n)", raw[: skip + PDF_TEXT_WITHIN])
    if not opened or not raw[opened.end() :].lstrip(_SPACE).startswith(b"%PDF-"):
        return False
    bare = [x.strip().lower() for x in raw[skip:].splitlines()]
    marks = [b"<document>", b"<text>", b"</text>", b"</document>"]
    if any(bare.count(m) != 1 for m in marks):
        return False
    at = [bare.index(m) for m in marks]
    if at != sorted(at) or any(bare[: at[0]]) or any(bare[at[2] + 1 : at[3]]) or any(bare[at[3] + 1 :]):
        return False
    headers: dict[str, str] = {}
    try:
        for line in filter(None, bare[at[0] + 1 : at[1]]):
            m = _HEADER.fullmatch(line.decode("latin-1"))
            if not m:
                return False
            _header(m[1], m[2].strip(), headers)
    except EnvelopeError:
        return False
    return bool(headers.get("type"))


def segments(raw: bytes) -> list[bytes] | None:
    """The documents of a full submission; None where opening and closing lines differ in number."""
    opened = [m.start() for m in re.finditer(rb"(?im)^[ \t]*<DOCUMENT>[ \t]*\r?$", raw)]
    closed = [m.end() for m in re.finditer(rb"(?im)^[ \t]*</DOCUMENT>[ \t]*\r?\n?", raw)]
    return [raw[a:b] for a, b in zip(opened, closed, strict=True)] if len(opened) == len(closed) else None
