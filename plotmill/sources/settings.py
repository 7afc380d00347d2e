"""Settings, templates and lists the driver reads."""

from __future__ import annotations

import json
import tomllib
from pathlib import Path
from typing import Any

_ABSENT = object()


class Settings:
    """Layered settings. An override stands in for the user's layer as long as it lasts (Q-22); defaults are asked last."""

    def __init__(self, default: dict | None = None, user: dict | None = None):
        self.default, self.user = default or {}, user or {}
        self.override: dict | None = None

    @classmethod
    def load(cls, default: str | Path, user: str | Path | None = None) -> Settings:
        return cls(_toml(default), _toml(user) if user and Path(user).exists() else {})

    def override_with(self, settings: dict | str | Path) -> None:
        self.override = settings if isinstance(settings, dict) else _toml(settings)

    def drop_override(self) -> None:
        self.override = None

    def get(self, path: str, other: Any = _ABSENT) -> Any:
        """The value at a dotted path; `other` if no layer has it, an error if that is not given."""
        for layer in (self.user if self.override is None else self.override, self.default):
            value: Any = layer
            for step in path.split("."):
                value = value.get(step, _ABSENT) if isinstance(value, dict) else _ABSENT
                if value is _ABSENT:
                    break
            else:
                return value
        if other is not _ABSENT:
            return other
        raise KeyError(f"no setting {path!r}")


def _toml(path: str | Path) -> dict:
    return tomllib.loads(Path(path).read_text("utf-8"))


def template(path: str | Path) -> tuple[str, dict]:
    """A few-shot template and the parameters beside it (`<name>.params.json`; none if there is no such file)."""
    beside = Path(str(path).removesuffix(".txt") + ".params.json")
    return Path(path).read_text("utf-8"), json.loads(beside.read_text("utf-8")) if beside.exists() else {}


def replacement_lists(path: str | Path) -> dict[str, list[str]]:
    """The value lists beside a template (`<name>.replacements.json`)."""
    return json.loads(Path(str(path).removesuffix(".txt") + ".replacements.json").read_text("utf-8"))


def json_file(path: str | Path) -> Any:
    """Name lists and translation maps; an empty map if there is no such file."""
    return json.loads(Path(path).read_text("utf-8")) if Path(path).exists() else {}


def extend_story_settings(path: str | Path, stories: list[str], keys: list[str]) -> list[str]:
    """Empty settings added to a file for `stories` it does not have; their names, for someone to fill in."""
    known: dict[str, dict[str, str]] = json_file(path)
    new = [s for s in stories if s not in known]
    if new:
        Path(path).write_text(json.dumps({s: {k: known.get(s, {}).get(k, "") for k in {*keys, *known.get(s, {})}} for s in [*known, *new]}, indent=2), "utf-8")
    return new
