"""What a run can use and how far it is: optional libraries, engines, progress."""

from __future__ import annotations

import importlib.util
import sys
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import TextIO

from foliary.sources.pdf import ENGINES

#: Libraries that a feature needs; an empty list needs none.
FEATURES = {"configuration": ("yaml",), "arrow": ("pyarrow",), "html": (), "docx": (), "transcript": (), "pdf": (), "layout": ("docling",), "recognition": ("httpx",), "extraction": ("trafilatura",)}


class MissingDependency(RuntimeError):
    """A feature was asked for whose library is not installed."""


def installed(package: str) -> bool:
    try:
        return importlib.util.find_spec(package) is not None
    except (ImportError, ValueError):
        return False


def available(feature: str) -> bool:
    """Whether all that a feature needs is installed, or an engine of its name is registered."""
    return feature in ENGINES or all(map(installed, FEATURES[feature]))


def require(feature: str) -> None:
    missing = [p for p in FEATURES[feature] if not installed(p)]
    if missing and feature not in ENGINES:
        raise MissingDependency(f"{feature} needs {', '.join(missing)}")


@dataclass
class Progress:
    """Counts steps and tells lines of progress; on a terminal in place, else only when a whole percent is reached.

    ``listener`` gets (done, total, label) for each step. Labels are made
    printable. Lines that others log while it runs go through :meth:`log`, so
    that they do not land in the middle of a line.
    """

    total: int
    out: TextIO = field(default_factory=lambda: sys.stderr)
    listener: Callable[[int, int, str], None] | None = None
    done: int = 0
    _shown: int = -1
    _began: float = field(default_factory=time.monotonic)

    @property
    def percent(self) -> int:
        """0 to 100; 100 of nothing to do, and not before all is done."""
        if self.total <= 0:
            return 100
        return min(100 if self.done >= self.total else 99, max(0, round(100 * self.done / self.total)))

    def step(self, label: str = "", n: int = 1) -> None:
        self.done += n
        label = "".join(c if c.isprintable() else " " for c in label)
        if self.listener is not None:
            self.listener(self.done, self.total, label)
        live = self.out.isatty()
        if live or self.percent != self._shown:
            self._shown = self.percent
            line = f"[{self.percent:3d}%] {self.done}/{self.total} {label}".rstrip()
            self.out.write(f"\r\x1b[K{line}" if live else f"{line}\n")
            self.out.flush()

    def log(self, line: str) -> None:
        self.out.write(f"\r\x1b[K{line}\n" if self.out.isatty() else f"{line}\n")

    def close(self) -> None:
        if self.out.isatty():
            self.out.write("\n")
        self.out.flush()

    def over(self, items: Iterable, label: Callable[[object], str] = str) -> Iterator:
        for x in items:
            yield x
            self.step(label(x))
        self.close()
