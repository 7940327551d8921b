import datetime
import json
import os

import pytest

from ledgerlode import config
from ledgerlode.sources import http, ingest, progress

URL = "https://data.sec.gov/submissions/CIK0000000001.json"


class Raw:
    def __init__(self, status=200, body=b"{}", **headers):
        self.status, self.headers, self.body = status, {k.replace("_", "-"): v for k, v in headers.items()}, body

    def read(self, n):
        part, self.body = self.body[:n], self.body[n:]
        return part


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def sleep(self, s):
        self.slept.append(round(s, 6))
        self.now += s


def client(*answers, **options):
    clock, asked = Clock(), []
    queue = list(answers)

    def transport(url, headers, timeout):
        asked.append((url, clock.now))
        x = queue.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    limiter = http.Limiter(clock=lambda: clock.now, sleep=clock.sleep)
    return http.Client("desk desk@filings.org", limiter, transport=transport, **options), clock, asked


def test_get_and_pace():
    c, clock, asked = client(Raw(body=b"a"), Raw(body=b"b"))
    assert c.get(URL).body == b"a" and c.get(URL).body == b"b"
    assert [t for _, t in asked] == [0.0, 0.2]


def test_retries():
    c, clock, asked = client(Raw(500), http.TransportTimeout("x"), Raw(body=b"ok", Content_Length="2"))
    assert c.get(URL).body == b"ok" and clock.slept == [0.5, 1.0]
    with pytest.raises(http.StatusError):
        client(*[Raw(500)] * 4)[0].get(URL)
    with pytest.raises(http.TransportError):
        client(http.TransportError("reset"))[0].get(URL)


def test_cooldown_is_shared_and_long_waits_are_deferred():
    c, clock, asked = client(Raw(429, Retry_After="7"), Raw())
    c.get(URL)
    assert asked[1][1] >= 7
    with pytest.raises(http.Deferred):
        client(Raw(503, Retry_After="61"))[0].get(URL)


@pytest.mark.parametrize(("answer", "error"), [(Raw(404), http.NotFound), (Raw(403), http.Forbidden), (Raw(206), http.Incomplete), (Raw(body=b"abc", Content_Length="4"), http.Incomplete), (Raw(body=b"abc", Content_Length="x"), http.Incomplete), (Raw(Content_Length="999"), http.TooLarge), (Raw(body=b"x" * 100), http.TooLarge), (Raw(302), http.BadRedirect), (Raw(302, Location="https://example.com/"), http.UnsafeUrl), (Raw(302, Location=URL), http.BadRedirect)])
def test_refusals(answer, error):
    with pytest.raises(error):
        client(answer, answer, most=50)[0].get(URL)


def test_redirects_are_checked():
    c, _, asked = client(Raw(301, Location="/b"), Raw(body=b"x"))
    assert c.get(URL).url == "https://data.sec.gov/b"


@pytest.mark.parametrize("url", ["http://data.sec.gov/a", "https://u@data.sec.gov/a", "https://data.sec.gov:444/a", "https://127.0.0.1/a", "https://example.com/", URL + "?q", URL + "#f", "https://data.sec.gov/../a", "https://data.sec.gov/%252e%252e/a", "https://data.sec.gov/a\\b", "https://data.sec.gov/a\tb", "https://data.sec.gov:x/"])
def test_unsafe_urls(url):
    with pytest.raises(http.UnsafeUrl):
        http.checked_url(url)


def test_agents_and_waits():
    assert http.checked_agent("Desk ann@filings.org")
    for bad in ("", "Desk", "a your-email@x.org", "a@example.com"):
        with pytest.raises(ValueError):
            http.checked_agent(bad)
    assert http.retry_after("3", 0) == 3 and http.retry_after("-3", 0) == 0 and http.retry_after("x", 0) is None
    assert http.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 20) == 40 and http.retry_after("9" * 400, 0) == float("inf")


def test_progress(tmp_path):
    path = tmp_path / "p.json"
    done = []
    assert ingest.run("s", ["a", "b", "a"], path, done.append) == [] and done == ["a", "b"]

    def fail(x):
        raise ValueError

    assert ingest.run("s", ["b", "c"], path, fail) == ["c"]
    assert progress.load(path)["s"] == {"a": "done", "b": "done", "c": "failed:ValueError"}
    assert ingest.run("s", ["c"], path, done.append) == [] and done == ["a", "b", "c"]
    assert ingest.run("s", ["a"], path, done.append, force=True) == [] and done[-1] == "a"
    assert not path.with_suffix(".lock").exists()


def test_lock(tmp_path):
    path = tmp_path / "x.lock"
    path.write_text("999999999")
    with progress.Lock(path):
        assert path.read_text() == str(os.getpid())
        with pytest.raises(RuntimeError), progress.Lock(path):
            pass
    assert not path.exists()


def test_financials_are_fetched_once(tmp_path):
    cache, asked = ingest.Cache(tmp_path), []

    def fetch(url):
        asked.append(url)
        return json.dumps({"filings": {"files": [{"name": "p1.json"}]}} if "submissions/CIK" in url else {}).encode()

    keys = ingest.fetch_financials(cache, "0000000001", fetch)
    assert len(keys) == 3 == len(asked) and ingest.fetch_financials(cache, "0000000001", fetch) == keys and len(asked) == 3
    record = cache.manifest()[keys[1]][0]
    (tmp_path / record["path"]).write_text("changed")
    ingest.fetch_financials(cache, "0000000001", fetch)
    assert len(asked) == 4


def test_macros_hide_the_key(tmp_path):
    cache = ingest.Cache(tmp_path)
    assert ingest.fetch_macros(cache, ["A", "B"], "https://x/obs", "KEY", lambda u: b"{}" if "=A" in u else b"<") == {"A": None, "B": "JSONDecodeError"}
    assert "KEY" not in (tmp_path / "manifest.log").read_text()
    cache.close()
    assert "KEY" not in (tmp_path / "manifest.json").read_text() and not (tmp_path / "manifest.log").exists()
    assert set(ingest.Cache(tmp_path).manifest()) == {"macro:A"}


def test_settings(tmp_path):
    path = tmp_path / "s.toml"
    path.write_text('data_dir = "d"\n[universe]\nexchanges = ["NYSE"]\n[market]\nthrottle = 1.5\ninterval = "1d"\n[filings]\nforms = ["10-K"]\n')
    s = config.load_settings(path)
    assert (str(s.data_dir), s.exchanges, s.forms, s.market.throttle, s.market.options) == ("d", ("NYSE",), ("10-K",), 1.5, {"interval": "1d"})
    for text in ("", "x =", 'data_dir = "d"\n[filings]\nforms = ["S-1"]', 'data_dir = "d"\n[market]\nthrottle = -1'):
        path.write_text(text)
        with pytest.raises(config.ConfigError):
            config.load_settings(path)
    with pytest.raises(config.ConfigError):
        config.load_secrets(tmp_path / "none.toml", "k")
    assert ingest.bar_range(datetime.date(2024, 1, 1), datetime.date(2024, 1, 31))[1] == datetime.date(2024, 2, 1)


def test_resource_hosts():
    hosts = http.allowed_hosts(["XBRL.sec.gov.", "www.w3.org"])
    assert http.upgraded("http://xbrl.SEC.gov/a.xsd", hosts) == http.checked_resource("https://xbrl.sec.gov:443/a.xsd", hosts) == "https://xbrl.sec.gov/a.xsd"
    for bad in ("https://sec.gov/a", "https://xbrl.sec.gov/%2e%2e/a", "https://u@xbrl.sec.gov/a", "https://xbrl.sec.gov:8443/a", "ftp://xbrl.sec.gov/a", "https://xbrl.sec.gov/a?b", "https://xbrl.sec.gov:/a"):
        with pytest.raises(http.UnsafeUrl):
            http.upgraded(bad, hosts)
    for bad in ("localhost", "a.local", "10.0.0.1", "1.2", "x", "-a.org", "a..b"):
        with pytest.raises(ValueError):
            http.canonical_host(bad)
    with pytest.raises(ValueError):
        http.allowed_hosts("www.w3.org")


def test_bars(tmp_path):
    import pandas as pd

    asked = []

    def source(ticker, start, end):
        asked.append((ticker, start, end))
        if len(asked) == 1:
            raise OSError("busy")
        return pd.DataFrame({"Open": [1.0], "Close": [2.0]}, index=pd.to_datetime(["2024-01-02"])) if ticker == "abc" else pd.DataFrame()

    day = datetime.date
    path = ingest.fetch_bars("abc", day(2024, 1, 2), day(2024, 1, 3), tmp_path, source, sleep=lambda s: None)
    assert path == tmp_path / "yahoo" / "ABC" / "2024-01-02_2024-01-03.csv" and path.read_text().startswith("date,Open,Close\n2024-01-02,1.0,2.0")
    assert asked[-1] == ("abc", day(2024, 1, 2), day(2024, 1, 4)) and len(asked) == 2
    assert ingest.fetch_bars("none", day(2024, 1, 2), day(2024, 1, 3), tmp_path, source) is None


def test_in_flight_is_bounded():
    import threading

    from ledgerlode.sources import fetch

    lock, now, most, taken = threading.Lock(), [0], [0], []

    def items():
        for i in range(20):
            taken.append(i)
            yield i

    def work(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        with lock:
            now[0] -= 1
        return i

    assert sorted(fetch.in_flight(items(), work, 3)) == list(range(20)) and most[0] <= 3
    with pytest.raises(fetch.Unselected):
        fetch.fetch_document({"selected": False, "status": "candidate", "url": URL}, None)
    said = []
    p = fetch.Progress(3, each=2, clock=iter(range(0, 100, 10)).__next__, say=said.append)
    for k in range(3):
        p.step(f"f{k}")
    assert [x.split(" ")[0] for x in said] == ["2/3", "3/3"]
