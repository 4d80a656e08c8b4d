"""A paged feed without a network, to show what ``paged`` calls: three pages of two items."""

from __future__ import annotations

import json


def feed(cursor: str | None) -> tuple[list[str], str | None]:
    page = int(cursor or 0)
    return [json.dumps({"page": page, "i": i}) for i in range(2)], (str(page + 1) if page < 2 else None)
