"""Cursor codec and limits of paged results."""

from __future__ import annotations

import base64
import json


def encode_cursor(sort_value, ident) -> str:
    body = json.dumps({"sortValue": sort_value, "id": ident, "direction": "forward"}, separators=(",", ":"), ensure_ascii=False)
    return base64.urlsafe_b64encode(body.encode()).decode().rstrip("=")


def decode_cursor(cursor: str | None) -> dict | None:
    """The cursor's fields, or None for anything malformed."""
    if not cursor:
        return None
    try:
        found = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
    except (ValueError, UnicodeDecodeError):
        return None
    return found if isinstance(found, dict) and {"sortValue", "id", "direction"} <= found.keys() else None


def parse_limit(value, default: int = 50, most: int = 500) -> int:
    """Invalid or below 1: the default; else at most ``most``."""
    try:
        n = int(value)
    except (TypeError, ValueError):
        return default
    return default if n < 1 else min(n, most)


def cut_page(rows: list, limit: int, sort_key, id_key) -> tuple[list, str | None]:
    """The first ``limit`` rows, and a cursor if more follow."""
    shown = rows[:limit]
    return shown, encode_cursor(shown[-1][sort_key], shown[-1][id_key]) if len(rows) > limit and shown else None
