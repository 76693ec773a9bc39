"""Profiles of settings: an overlay over defaults, and a registry by name."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any


def overlay(defaults: Mapping[str, Any], profile: Mapping[str, Any]) -> dict[str, Any]:
    """Defaults with the profile's settings in upper case over them; its other names are its own affair."""
    return {**defaults, **{k: v for k, v in profile.items() if k.isupper()}}


def chosen(profiles: Mapping[str, Any], name: str) -> Any:
    """The profile of that name; an unknown one is an error that lists those there are."""
    if name not in profiles:
        raise KeyError(f"no profile {name!r}; there are {', '.join(sorted(profiles))}")
    return profiles[name]
