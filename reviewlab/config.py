"""Settings of one run, fixed when the run starts."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


class ConfigError(RuntimeError):
    """A setting is missing or makes no sense."""


@dataclass(frozen=True)
class RunConfig:
    """Where a run reads and writes, and how it names itself.

    ``input_path`` and ``output_path`` are any Hadoop URIs. With ``persist`` off
    nothing is written to ``output_path``; the sinks only say that they skipped.
    """

    input_path: str
    output_path: str
    run_id: str
    persist: bool

    def __post_init__(self) -> None:
        for name in ("input_path", "output_path", "run_id"):
            if not getattr(self, name):
                raise ConfigError(f"setting '{name}' is missing")

    @property
    def features_root(self) -> str:
        return under(self.output_path, "features")

    @property
    def models_root(self) -> str:
        return under(self.output_path, "models")

    @property
    def violations_path(self) -> str:
        return under(self.output_path, "violations", self.run_id)

    @property
    def staging_path(self) -> str:
        return under(self.output_path, "_staging", self.run_id)

    @property
    def audit_path(self) -> str:
        return under(self.output_path, "audit")


def under(root: str, *names: str) -> str:
    """Join path segments with single slashes, whatever the scheme of ``root``."""
    return "/".join([root.rstrip("/"), *names])


def resolve(
    input_path: str | None,
    output_path: str | None,
    run_id: str,
    *,
    persist: bool = True,
    env: Mapping[str, str] = os.environ,
) -> RunConfig:
    """Arguments first, then ``REVIEWLAB_INPUT`` / ``REVIEWLAB_OUTPUT``; else ConfigError."""
    return RunConfig(
        input_path=input_path or env.get("REVIEWLAB_INPUT", ""),
        output_path=output_path or env.get("REVIEWLAB_OUTPUT", ""),
        run_id=run_id,
        persist=persist,
    )
