"""A bounded, paced GET client. It runs on the driver: a limit for each executor would multiply the rate."""

from __future__ import annotations

import ipaddress
import math
import re
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import unquote, urljoin, urlsplit, urlunsplit

HOSTS = ("data.sec.gov", "www.sec.gov")
CHUNK = 64 << 10


class FetchError(Exception):
    """Any failure of a request."""


class UnsafeUrl(FetchError):
    pass


class TransportError(FetchError):
    pass


class TransportTimeout(TransportError):
    pass


class TooLarge(FetchError):
    pass


class Incomplete(FetchError):
    pass


class BadRedirect(FetchError):
    pass


class StatusError(FetchError):
    def __init__(self, status: int, url: str):
        super().__init__(f"{status} for {url}")
        self.status = status


class Forbidden(StatusError):
    pass


class NotFound(StatusError):
    pass


class Deferred(StatusError):
    """The server asks for a longer wait than the client gives."""

    def __init__(self, status: int, url: str, seconds: float):
        super().__init__(status, url)
        self.seconds = seconds


@dataclass(frozen=True)
class Response:
    url: str
    status: int
    headers: dict[str, str]
    body: bytes


#: Host names of no public network, and how often a path is decoded.
LOCAL_HOSTS = ("localhost", ".localhost", ".local", ".localdomain")
DECODES = 5
_LABEL = re.compile(r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?")


def _parts(url: str, scheme: str):
    """The parts of an absolute URL without hidden characters, credentials, odd ports or a way out of its path."""
    if not isinstance(url, str) or not url or re.search(r"[\x00-\x1f\x7f]", url):
        raise UnsafeUrl("control character")
    if re.search(r"%(?![0-9a-fA-F]{2})", url):
        raise UnsafeUrl("malformed percent escape")
    try:
        parts = urlsplit(url)
        port = parts.port
    except ValueError as e:
        raise UnsafeUrl(str(e)) from e
    if parts.scheme.casefold() != scheme or not parts.netloc:
        raise UnsafeUrl("scheme")
    if parts.username is not None or parts.password is not None:
        raise UnsafeUrl("credentials")
    if port not in (None, 443 if scheme == "https" else 80):
        raise UnsafeUrl("port")
    path = parts.path
    for _ in range(DECODES):
        now = unquote(path)
        if now == path:
            break
        path = now
    else:
        raise UnsafeUrl("nested escapes")
    if re.search(r"[\\\x00-\x1f\x7f]|(?:^|/)\.{1,2}(?:/|$)|^//", path):
        raise UnsafeUrl("traversal")
    return parts


def checked_url(url: str, hosts: tuple[str, ...] = HOSTS, queries: bool = False) -> str:
    """The URL itself, or ``UnsafeUrl``: https, a listed host, the usual port, nothing hidden, no way out of its path."""
    parts = _parts(url, "https")
    if (parts.hostname or "").casefold() not in hosts:
        raise UnsafeUrl("host")
    if "#" in url or "?" in url and not queries:
        raise UnsafeUrl("query or fragment")
    return url


def canonical_host(host: str, dotted: bool = False) -> str:
    """A public host's exact name in lower case and ASCII, or ``ValueError``; with ``dotted``, a dot at the end is dropped."""
    if not isinstance(host, str):
        raise ValueError("a host is a name")
    name = host.strip().lower()
    name = name[:-1] if dotted and name.endswith(".") else name
    try:
        name = name.encode("idna").decode("ascii").lower()
    except UnicodeError as e:
        raise ValueError(f"bad host {host!r}") from e
    labels = name.split(".")
    plain = len(labels) >= 2 and len(name) <= 253 and all(map(_LABEL.fullmatch, labels)) and not all(x.isdigit() for x in labels)
    if not plain or any(name == x or x[0] == "." and name.endswith(x) for x in LOCAL_HOSTS):
        raise ValueError(f"bad host {host!r}")
    try:
        ipaddress.ip_address(name)
    except ValueError:
        return name
    raise ValueError("an address isn't a host name")


def allowed_hosts(hosts) -> tuple[str, ...]:
    if isinstance(hosts, str | bytes):
        raise ValueError("hosts must be a collection")
    return tuple(sorted({canonical_host(h, dotted=True) for h in hosts}))


def checked_resource(url: str, hosts: tuple[str, ...], scheme: str = "https") -> str:
    """The URL with its host's exact name, or ``UnsafeUrl``; ``hosts`` are those of ``allowed_hosts``."""
    parts = _parts(url, scheme)
    if "?" in url or "#" in url:
        raise UnsafeUrl("query or fragment")
    if parts.netloc.endswith(":"):
        raise UnsafeUrl("port")
    try:
        host = canonical_host(parts.hostname or "")
    except ValueError as e:
        raise UnsafeUrl("host") from e
    if host not in hosts:
        raise UnsafeUrl("host")
    return urlunsplit((scheme, host, parts.path or "/", "", ""))


def upgraded(url: str, hosts: tuple[str, ...]) -> str:
    """The https form of a resource named by http or https; nothing is ever asked for without encryption."""
    if urlsplit(url).scheme.casefold() == "http":
        url = "https" + checked_resource(url, hosts, "http")[4:]
    return checked_resource(url, hosts)


def checked_agent(agent: str) -> str:
    """A user agent with the address of a person."""
    m = re.search(r"[\w.+-]+@([\w-]+\.)+[a-z]{2,}", agent or "", re.I)
    if not m or re.search(r"@(?:[\w-]+\.)*example\.|your[-_.]?e?mail|^test@", m[0], re.I):
        raise ValueError("the user agent needs a contact address")
    return agent


def retry_after(value: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks for; never negative."""
    if value is None:
        return None
    value = value.strip()
    if re.fullmatch(r"[+-]?[0-9]+(\.[0-9]+)?", value):
        return max(0.0, float(value)) if len(value) < 300 else math.inf
    try:
        return max(0.0, parsedate_to_datetime(value).timestamp() - now)
    except (TypeError, ValueError):
        return None


@dataclass
class Limiter:
    """Keeps requests of all clients that share it apart, and all of them away while a server cools down."""

    interval: float = 0.2
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _next: float = 0.0
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def wait(self) -> None:
        with self._lock:  # the slot is taken here; the request itself runs outside
            now = self.clock()
            at = max(now, self._next)
            self._next = at + self.interval
        if at > now:
            self.sleep(at - now)

    def cool(self, seconds: float) -> None:
        with self._lock:
            self._next = max(self._next, self.clock() + seconds)


def open_url(url: str, headers: dict[str, str], timeout: float):
    """The default transport: a response with status, headers and read(n); redirects aren't followed."""

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *a, **b):
            return None

    try:
        return urllib.request.build_opener(Stay).open(urllib.request.Request(url, headers=headers), timeout=timeout)
    except urllib.error.HTTPError as e:
        return e
    except TimeoutError as e:
        raise TransportTimeout(str(e)) from e
    except OSError as e:
        raise (TransportTimeout if isinstance(getattr(e, "reason", None), TimeoutError) else TransportError)(str(e)) from e


@dataclass
class Client:
    """GET with checks: URL policy at every hop, pacing, retries of 429, 5xx and timeouts, whole bodies of bounded size."""

    agent: str
    limiter: Limiter = field(default_factory=Limiter)
    hosts: tuple[str, ...] = HOSTS
    transport: Callable = open_url
    retries: int = 3
    backoff: float = 0.5
    longest: float = 8.0
    patience: float = 60.0
    redirects: int = 5
    most: int = 128 << 20
    timeout: float = 30.0

    def __post_init__(self):
        checked_agent(self.agent)
        if self.limiter.interval < 0.2:
            raise ValueError("requests must be at least 0.2 s apart")

    def get(self, url: str) -> Response:
        for attempt in range(self.retries + 1):
            wait = min(self.backoff * 2**attempt, self.longest)
            last = attempt == self.retries
            try:
                response = self._once(url)
            except TransportTimeout:
                if last:
                    raise
                self.limiter.sleep(wait)
                continue
            status = response.status
            if status == 200:
                return response
            if status in (403, 404):
                raise (Forbidden if status == 403 else NotFound)(status, url)
            if 200 <= status < 300:
                raise Incomplete(f"{status} for {url}")
            if status != 429 and status < 500:
                raise StatusError(status, url)
            asked = retry_after(response.headers.get("retry-after"), time.time())
            if status in (429, 503):
                self.limiter.cool(min(asked if asked is not None else wait, self.patience))
            if asked is not None and asked > self.patience:
                raise Deferred(status, url, asked)
            if last:
                raise StatusError(status, url)
            self.limiter.sleep(asked if asked is not None else wait)
        raise AssertionError

    def _once(self, url: str) -> Response:
        seen = set()
        for _ in range(self.redirects + 1):
            url = self._checked(url)
            if url in seen:
                raise BadRedirect(f"loop at {url}")
            seen.add(url)
            self.limiter.wait()
            raw = self.transport(url, {"User-Agent": self.agent, "Accept-Encoding": "identity"}, self.timeout)
            headers = {k.lower(): v for k, v in dict(raw.headers).items()}
            if raw.status in (301, 302, 303, 307, 308):
                if "location" not in headers:
                    raise BadRedirect(f"no target from {url}")
                url = urljoin(url, headers["location"])
                continue
            return Response(url, raw.status, headers, self._body(raw, headers) if raw.status == 200 else b"")
        raise BadRedirect(f"too many hops to {url}")

    def _checked(self, url: str) -> str:
        return checked_url(url, self.hosts)

    def _body(self, raw, headers: dict[str, str]) -> bytes:
        length = headers.get("content-length")
        if length is not None and not re.fullmatch("[0-9]{1,18}", length.strip()):
            raise Incomplete(f"content length {length!r}")
        if length is not None and int(length) > self.most:
            raise TooLarge(length)
        parts, size = [], 0
        while part := raw.read(CHUNK):
            size += len(part)
            if size > self.most:
                raise TooLarge(str(size))
            parts.append(part)
        if length is not None and size != int(length):
            raise Incomplete(f"{size} of {length} bytes")
        return b"".join(parts)


@dataclass
class ResourceClient(Client):
    """A client of an explicit list of hosts, for taxonomies; names that say http are asked for by https, redirects must be https."""

    def __post_init__(self):
        super().__post_init__()
        self.hosts = allowed_hosts(self.hosts)

    def _checked(self, url: str) -> str:
        return checked_resource(url, self.hosts)

    def fetch(self, url: str) -> Response:
        """One resource; ``url`` of the response is where it came from."""
        return self.get(upgraded(url, self.hosts))
