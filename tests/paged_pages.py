"""Pages for the paged source: seven pages of ten records."""


def fetch(page, payload):
    if page > 7:
        return None
    rows = [{"county": f"72{(page * 10 + i) % 3:03d}", "amount": float(page * 10 + i), "year": 2000 + page} for i in range(10)]
    for name, allowed in payload.get("equal", {}).items():
        rows = [r for r in rows if r[name] in allowed]
    for name, low in payload.get("from", {}).items():
        rows = [r for r in rows if r[name] >= low]
    for name, high in payload.get("to", {}).items():
        rows = [r for r in rows if r[name] <= high]
    return rows
