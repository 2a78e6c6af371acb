"""A server of JSON files below a folder: filters, orders, pages and counts as a REST server has them.

Rows that the order leaves equal come in another order with every request, as a
server is free to send them.
"""

import json
import random
import re

from aeroperf.sources.rest import PAGE_ROWS


def _holds(value, said: str) -> bool:
    """Whether a JSON value passes a filter; numbers are compared as numbers, as a server does."""
    op, _, arg = said.partition(".")
    if op == "is":
        return value is None
    if value is None or isinstance(value, (list, dict)):
        return False
    if op == "in":
        return any(str(value) == (x[1:-1].replace('\\"', '"').replace("\\\\", "\\") if x.startswith('"') else x) for x in re.findall(r'"(?:[^"\\]|\\.)*"|[^,]+', arg[1:-1]))
    if op == "like":
        return re.fullmatch("".join(".*" if c in "*%" else "." if c == "_" else re.escape(c) for c in arg), str(value), re.DOTALL) is not None
    a, b = (value, float(arg)) if isinstance(value, (int, float)) else (str(value), arg)
    return {"eq": a == b, "gt": a > b, "gte": a >= b, "lt": a < b, "lte": a <= b}[op]


def folder_rows(base: str, table: str, params: dict[str, str]) -> list[dict]:
    """Rows of ``base/table.json`` that pass all filters."""
    with open(f"{base}/{table}.json") as f:
        rows = json.load(f)
    said = [(c, f"{op}.{v}") for c, op, v in re.findall(r"(\w+)\.(gte|lt)\.([^,()]+)", params.get("and", ""))]
    said += [(k, v) for k, v in params.items() if k not in ("and", "order", "select", "offset", "limit")]
    return [r for r in rows if all(_holds(r.get(c), v) for c, v in said)]


def folder_count(base: str, table: str, params: dict[str, str]) -> int:
    return len(folder_rows(base, table, params))


def count_of_more(base: str, table: str, params: dict[str, str]) -> int:
    """Of a server that got a row while its pages were read."""
    return folder_count(base, table, params) + 1


def folder_fetch(base: str, table: str, params: dict[str, str]) -> list[dict]:
    """What ``http_fetch`` gives, from ``base/table.json``: bounds, filters, order, offset and limit."""
    rows = folder_rows(base, table, params)
    order = [c for c in params.get("order", "").split(",") if c]
    random.shuffle(rows)
    rows = sorted(rows, key=lambda r: [str(r.get(c, "")) for c in order])
    at = int(params.get("offset", 0))
    return rows[at : at + int(params.get("limit", PAGE_ROWS))]


def clock(base: str) -> str:
    with open(f"{base}/clock") as f:
        return f.read()
