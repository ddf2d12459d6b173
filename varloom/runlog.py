"""What a run did: its inputs and outputs, settings, counts and surroundings."""

from __future__ import annotations

import hashlib
import json
import platform
import subprocess
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

#: Files beyond this size are recorded without a digest.
MOST_HASHED = 4 << 30


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def human_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def file_facts(path: str) -> dict[str, Any]:
    """Size and digest of a local file; a path that is none is only named."""
    p = Path(path)
    if not p.is_file():
        return {"path": path}
    size = p.stat().st_size
    digest = None
    if size < MOST_HASHED:
        with p.open("rb") as f:
            digest = hashlib.file_digest(f, "sha256").hexdigest()
    return {"path": path, "bytes": size, "sha256": digest}


def revision(folder: Path) -> str | None:
    try:
        done = subprocess.run(["git", "-C", str(folder), "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=False)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return done.stdout.strip() or None


@dataclass
class RunLog:
    step: str
    started: str = field(default_factory=utc_now)
    inputs: dict[str, dict] = field(default_factory=dict)
    outputs: list[str] = field(default_factory=list)
    settings: dict[str, Any] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    lines: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.begin = time.monotonic()

    def say(self, text: str) -> None:
        self.lines.append(f"{utc_now()} {text}")

    def add_input(self, role: str, path: str) -> None:
        self.inputs[role] = file_facts(path)

    def count(self, name: str, n: int = 1) -> None:
        self.counters[name] = self.counters.get(name, 0) + n

    def record(self, spark: SparkSession, status: str = "ok") -> str:
        """The run as one JSON text with sorted keys."""
        return json.dumps({
            "step": self.step, "status": status, "started": self.started, "finished": utc_now(), "seconds": round(time.monotonic() - self.begin, 3), "inputs": self.inputs, "outputs": self.outputs, "settings": self.settings, "counters": self.counters, "log": self.lines,
            "environment": {"python": platform.python_version(), "system": platform.platform(), "spark": spark.version, "master": spark.sparkContext.master, "revision": revision(Path(__file__).resolve().parent)},
        }, sort_keys=True, indent=1, default=str)


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """A small text, made on the driver, as one part."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
