"""The pairing rules on plain Python rows, written from their description: the yardstick for random changes."""


def expected_events(rows, primary_key, strict):
    """``rows`` of one change as dicts; returns (op, serial, image) in order, or raises ValueError."""
    rows = sorted(rows, key=lambda r: r["operation"])
    codes = "".join(str(r["operation"]) for r in rows)
    if codes == "34":
        return [("u", 2, rows[1])]
    if codes == "12":
        if any(rows[0][k] != rows[1][k] for k in primary_key):
            return [("d", 1, rows[0]), ("c", 2, rows[1])]
        return [("u", 2, rows[1])]
    if strict and ("3" in codes or "4" in codes):
        raise ValueError("incomplete")
    if any(r["operation"] not in (1, 2, 3, 4) for r in rows):
        raise ValueError("unknown")
    names = {1: "d", 2: "c"}
    return [(names[r["operation"]], at, r) for at, r in enumerate(rows, 1) if r["operation"] in names]
