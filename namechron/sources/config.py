"""Settings of the reader client: environment first, then a settings file."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from pathlib import Path


class SettingsError(ValueError):
    """A setting that is needed is missing."""


@dataclass(frozen=True)
class ReaderSettings:
    base_url: str
    api_key: str


def read_env_file(path: str | Path) -> dict[str, str]:
    """NAME=value lines of a file, quotes taken off; comments and other lines don't count."""
    if not Path(path).is_file():
        return {}
    pairs = (line.strip().split("=", 1) for line in Path(path).read_text(encoding="utf-8").splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}


def reader_settings(model: str, env_file: str | Path = ".env", prefix: str = "READER") -> ReaderSettings:
    """URL and key for a model: its own key comes before the general one."""
    values = read_env_file(env_file) | dict(os.environ)
    name = re.sub(r"[^A-Z0-9]+", "_", model.upper())
    url = re.sub(r"/chat/completions/?$", "", values.get(f"{prefix}_BASE_URL", "")).rstrip("/")
    key = values.get(f"{prefix}_API_KEY_{name}") or values.get(f"{prefix}_API_KEY")
    if not url or not key:
        raise SettingsError(f"{prefix}_BASE_URL and {prefix}_API_KEY are needed")
    return ReaderSettings(url, key)
