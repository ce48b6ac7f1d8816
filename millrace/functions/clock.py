"""Execution instants given as text."""

from __future__ import annotations

from datetime import datetime, timezone


def parse_instant(text: str) -> datetime:
    """ISO 8601 to an aware UTC-based instant; ``Z`` is understood, a naive text means UTC."""
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        moment = datetime.fromisoformat(text[:19])
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def run_slug(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).strftime("%Y%m%d_%H%M%S")
