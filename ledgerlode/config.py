"""Typed settings from TOML files."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from ledgerlode.operators.catalog import DEFAULT_FORMS, checked_forms


class ConfigError(Exception):
    """A setting that is missing or wrong."""


@dataclass(frozen=True)
class Source:
    """Pace and retries of one source; ``options`` holds what only that source knows."""

    throttle: float
    retries: int = 3
    timeout: float = 30.0
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    data_dir: Path
    exchanges: tuple[str, ...] = ("Nasdaq", "NYSE")
    universe_url: str = "https://www.sec.gov/files/company_tickers_exchange.json"
    forms: tuple[str, ...] = DEFAULT_FORMS
    market: Source = Source(0.5)
    financials: Source = Source(0.2)
    macros: Source = Source(0.1)


def _read(path: Path) -> dict:
    try:
        return tomllib.loads(path.read_text(encoding="utf-8"))
    except FileNotFoundError as e:
        raise ConfigError(f"{path} is missing") from e
    except tomllib.TOMLDecodeError as e:
        raise ConfigError(f"{path}: {e}") from e


def _source(table: dict, default: Source) -> Source:
    known = {k: table[k] for k in ("throttle", "retries", "timeout") if k in table}
    if any(not isinstance(v, int | float) or v < 0 for v in known.values()):
        raise ConfigError(f"bad number in {known}")
    return Source(**({"throttle": default.throttle} | known), options={k: v for k, v in table.items() if k not in known})


def load_settings(path: Path, data_dir: Path | None = None) -> Settings:
    """Settings from ``path``; ``data_dir`` takes the place of the file's."""
    raw = _read(Path(path))
    place = data_dir or raw.get("data_dir")
    if not place:
        raise ConfigError("data_dir is missing")
    try:
        forms = checked_forms(raw.get("filings", {}).get("forms", DEFAULT_FORMS))
    except ValueError as e:
        raise ConfigError(str(e)) from e
    own = {k: _source(raw.get(k, {}), getattr(Settings, k)) for k in ("market", "financials", "macros")}
    listed = raw.get("universe", {})
    return Settings(Path(place), tuple(listed.get("exchanges", Settings.exchanges)), str(listed.get("url", Settings.universe_url)), forms, **own)


def load_secrets(path: Path, *names: str) -> dict[str, str]:
    """The named secrets; each has to be there."""
    raw = _read(Path(path))
    absent = [n for n in names if not raw.get(n)]
    if absent:
        raise ConfigError(f"{', '.join(absent)} missing in {path}")
    return {n: str(raw[n]) for n in names}
