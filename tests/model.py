"""The netting step in plain Python on a handful of rows, level by level."""

from __future__ import annotations

ZEROS = {"D": "0000", "C": "000", "B": "00"}


def level(ced):
    if ced is None:
        return None
    return next((name for name, z in ZEROS.items() if ced.endswith(z)), "A")


def any3(flags):
    flags = list(flags)
    return True if True in flags else None if None in flags else False


def net(rows, units, rules):
    """Rows are dicts with file, pos, ugb, funcao, programa, fr, ced, x."""
    out = []
    for file in sorted({r["file"] for r in rows}):
        mine = sorted((dict(r) for r in rows if r["file"] == file), key=lambda r: r["pos"])
        out += _net_file(mine, units, rules)
    return out


def _net_file(rows, units, rules):
    for r in rows:
        r["level"] = level(r["ced"])
        parts = [r[c] for c in ("ugb", "funcao", "programa", "fr")]
        for k in (2, 3, 4, 5):
            p = None if r["ced"] is None else r["ced"][:k]
            whole = rules.null_keys == "separate" or None not in (*parts, p)
            r[k] = (*parts, p) if whole else None
    if rules.prefilter:
        rows = [r for r in rows if r["ced"] is not None and (r["ugb"] or "")[:9] in units]

    def has(name, k, among=None):
        ids = {r[k] for r in rows} if among is None else among
        return {i: any3(None if r["level"] is None else r["level"] == name for r in rows if r[k] == i)
                for i in ids}

    def yes(flags, value):
        return {i for i, f in flags.items() if f is value}

    def sub(ids, k, levels, zeros):
        group = [dict(r) for r in rows if r[k] in ids and r["level"] in set(levels)]
        for r in group:
            r["is_parent"] = r["ced"].endswith(zeros)
        return [_netted(r, [s for s in group if s[k] == r[k]]) for r in group]

    has_c = has("C", 2)
    has_b = has("B", 2, yes(has_c, False))
    has_a = has("A", 2, yes(has_b, False))
    last = yes(has_b, False) if rules.lone_d == "keep" else yes(has_a, True)
    d = (sub(yes(has_c, True), 2, "CD", "0000") + sub(yes(has_b, True), 2, "BD", "0000")
         + sub(last, 2, "AD", "0000"))

    has_b = has("B", 3)
    has_a = has("A", 3, yes(has_b, False))
    last = yes(has_b, False) if rules.lone_c == "C" else yes(has_a, True)
    zeros = "00" if rules.c_over_a == "subtract" else "0000"
    c = sub(yes(has_b, True), 3, "BC", "000") + sub(last, 3, "AC", zeros)

    b = sub(yes(has("A", 4), True), 4, "AB", "00")
    a = [dict(r, is_parent=None) for r in rows if r["level"] == "A"] if rules.a_rows == "own_level" else []

    stacked = [r for part in (a, b, c, d) for r in part]  # by priority, each in its own order
    seen, kept = set(), []
    for r in stacked:
        key = {"prefix5": r[5], "unit_ced": (r[5], r["ced"]), "ced": r["ced"]}[rules.dedup_key]
        if key not in seen:
            seen.add(key)
            kept.append(r)
    return kept


def _netted(r, group):
    if not r["is_parent"] or r["x"] is None:
        return r
    children = sum(s["x"] for s in group if not s["is_parent"] and s["x"] is not None)
    return dict(r, x=r["x"] - children)
