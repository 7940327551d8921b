"""Work lists on the driver: a status for each item of each stage, saved whole or not at all, and one writer at a time."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

PENDING, DONE = "pending", "done"


def save(path: Path, state: dict) -> None:
    """Replaces the file in one step; what is on disk is always a whole state."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump(state, f, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
        folder = os.open(path.parent, os.O_RDONLY)
        try:
            os.fsync(folder)
        finally:
            os.close(folder)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def load(path: Path) -> dict:
    return json.loads(path.read_text(encoding="utf-8")) if path.exists() else {}


def initialize(path: Path, stage: str, items, force: bool = False) -> dict:
    """The state with each of ``items`` listed; what was done stays done unless ``force``."""
    state = load(path)
    held = {} if force else state.get(stage, {})
    state[stage] = held | {i: held.get(i, PENDING) for i in items}
    save(path, state)
    return state


def pending(state: dict, stage: str, items) -> list[str]:
    """Those of ``items``, in their order, that aren't done; earlier failures among them, other runs' items not."""
    return [i for i in dict.fromkeys(items) if state.get(stage, {}).get(i) != DONE]


def mark(path: Path, state: dict, stage: str, item: str, failed: str | None = None) -> None:
    state.setdefault(stage, {})[item] = DONE if failed is None else f"failed:{failed}"
    save(path, state)


class Lock:
    """A file with the owner's process id; one whose process is gone is taken over."""

    def __init__(self, path: Path):
        self.path = path

    def __enter__(self) -> Lock:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        for _ in range(3):
            try:
                handle = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                if self._alive():
                    raise RuntimeError(f"{self.path} is held by another run") from None
                self.path.unlink(missing_ok=True)
                continue
            os.write(handle, str(os.getpid()).encode())
            os.close(handle)
            return self
        raise RuntimeError(f"can't take {self.path}")

    def _alive(self) -> bool:
        try:
            owner = int(self.path.read_text())
            os.kill(owner, 0)
        except PermissionError:
            return True
        except (OSError, ValueError, OverflowError):
            return False
        return owner > 0

    def __exit__(self, *_) -> None:
        self.path.unlink(missing_ok=True)
