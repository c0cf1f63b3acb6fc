"""Configuration: a file, overridden by ``a.b=value`` pairs."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from .errors import RequestError


def load(path: str | Path, overrides: list[str] | None = None) -> dict[str, Any]:
    """A JSON file, or a YAML one where that library is installed, with overrides merged in."""
    p = Path(path)
    if p.suffix == ".json":
        base = json.loads(p.read_text())
    elif p.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as e:
            raise RequestError("YAML needs the yaml library") from e
        base = yaml.safe_load(p.read_text()) or {}
    else:
        raise RequestError(f"no configuration reader for {p.name}")
    return merge(none_to_null(base), parse_pairs(overrides or []))


def find(folder: str | Path, stem: str) -> Path:
    """The first file of that name with a known suffix."""
    for suffix in (".yaml", ".yml", ".json"):
        if (p := Path(folder, stem + suffix)).is_file():
            return p
    raise RequestError(f"no configuration {stem} in {folder}")


def none_to_null(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: none_to_null(v) for k, v in value.items()}
    return None if isinstance(value, str) and value.lower() == "none" else value


def merge(base: dict, over: dict) -> dict:
    """Tables are merged key by key, anything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def parse_pairs(pairs: list[str]) -> dict[str, Any]:
    """``a.b=x`` gives nested tables; a key that is both a value and a table is an error."""
    out: dict[str, Any] = {}
    for pair in pairs:
        name, sign, value = pair.partition("=")
        if not sign or not name.strip():
            raise RequestError(f"not a key=value pair: {pair}")
        at, keys = out, name.strip().split(".")
        for k in keys[:-1]:
            at = at.setdefault(k, {})
            if not isinstance(at, dict):
                raise RequestError(f"{name} goes on where a value stands")
        if isinstance(at.get(keys[-1]), dict):
            raise RequestError(f"{name} is a table already")
        at[keys[-1]] = none_to_null(value.strip())
    return out
