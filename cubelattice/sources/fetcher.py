"""Pace and retries of the driver-side fetching job. No executor calls the source."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

# Seconds between requests, and tries.
INTERVAL = 0.75
RETRIES = 3


@dataclass
class Response:
    status: int
    body: str
    headers: dict[str, str]


class RateLimited:
    """Calls ``send`` at most once per interval; waits and tries again when told to slow down."""

    def __init__(self, send: Callable[[str], Response], interval: float = INTERVAL, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.send, self.interval, self.clock, self.sleep, self.last = send, interval, clock, sleep, None

    def __call__(self, url: str) -> Response:
        for attempt in range(RETRIES + 1):
            if self.last is not None and (wait := self.last + self.interval - self.clock()) > 0:
                self.sleep(wait)
            self.last = self.clock()
            found = self.send(url)
            if found.status != 429 or attempt == RETRIES:
                return found
            after = found.headers.get("Retry-After", "")
            self.sleep(float(after) if after.isdigit() else self.interval * 2 ** (attempt + 1))
        raise AssertionError("unreachable")


def pivot_request(selection: list[list[int]], code: str, language: str = "ro", details: dict | None = None) -> dict:
    """The body of a cube request."""
    details = details or {}
    return {"encQuery": ":".join(",".join(map(str, x)) for x in selection), "language": language, "matCode": code, "matMaxDim": details.get("matMaxDim", len(selection)), "matRegJ": details.get("matRegJ", 0), "matUMSpec": details.get("matUMSpec", 0)}
