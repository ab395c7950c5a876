"""Settings of a run: defaults, a profile over them, a TOML file below it, overrides above it."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from pathlib import Path
from typing import Any

#: Defaults and profiles.
DEFAULTS: dict[str, Any] = {
    "profile": "balanced",
    "limits": {"shard_pages": 20, "max_attempts": 3},
    "clean": {"dehyphenate": True, "fix_spaced_letters": True},
    "quality": {"verified": 0.95, "good": 0.85, "review": 0.70},
    "dataset": {"filter_boilerplate": True, "sft_format": "both", "chunk_words": 400, "merge_all": True},
}
PROFILES: dict[str, dict[str, Any]] = {"fast": {"limits": {"shard_pages": 30}}, "balanced": {}, "accurate": {"limits": {"shard_pages": 10}}, "lowram": {"limits": {"shard_pages": 10}}}


def merged(low: Mapping[str, Any], high: Mapping[str, Any]) -> dict[str, Any]:
    """``low`` with the values of ``high`` over it, key by key at every depth."""
    out = dict(low)
    for k, v in high.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def load(path: str | Path | None = None, overrides: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Settings of a run, checked. ``path`` is a TOML file or a folder with ``quire.toml``."""
    given: Mapping[str, Any] = {}
    if path is not None:
        p = Path(path)
        p = p / "quire.toml" if p.is_dir() else p
        if p.is_file():
            given = tomllib.loads(p.read_text(encoding="utf-8"))
    over = overrides or {}
    profile = over.get("profile", given.get("profile", DEFAULTS["profile"]))
    if profile not in PROFILES:
        raise ValueError(f"no such profile: {profile}")
    out = merged(merged(merged(DEFAULTS, given), PROFILES[profile]), over)
    if out["dataset"]["sft_format"] not in ("alpaca", "chatml", "both"):
        raise ValueError(f"no such format: {out['dataset']['sft_format']}")
    if not 0 <= out["quality"]["review"] <= out["quality"]["good"] <= out["quality"]["verified"] <= 1:
        raise ValueError("quality thresholds must rise from review to verified")
    for k in ("shard_pages", "max_attempts"):
        if int(out["limits"][k]) < 1:
            raise ValueError(f"limits.{k} must be at least 1")
    return out
