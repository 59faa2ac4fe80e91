"""The cheapest matching of rows to columns in polynomial time, and which of several equally cheap ones.

Costs are whole numbers (fixed point), so that sums don't depend on their order and equal costs
are equal.  Every row may stay unmatched at a penalty.  Among matchings of the least cost the
first in depth-first order is wanted: row by row, unmatched comes before the columns in order.

Rows whose own cheapest choices don't clash are settled at once.  Otherwise the rows and columns
that can reach each other form groups; in each one, shortest augmenting paths with dual prices
give an optimum, and the prices say which edges any optimum may use.  The wanted one is found by
turning alternating paths over these edges, row by row.
"""

from __future__ import annotations

#: Units to a metre: a billionth, far under what a measurement tells.
UNIT = 1 << 30


def cheapest(costs: list[dict[int, int]], penalty: int) -> list[int | None]:
    """The column of each row, or None; ``costs`` has each row's possible columns."""
    choice = _settled(costs, penalty)
    if choice is not None:
        return choice
    out: list[int | None] = [None] * len(costs)
    for rows, columns in _groups(costs):
        local = [{columns[c]: x for c, x in costs[r].items()} for r in rows]
        names = sorted(columns, key=columns.__getitem__)
        for r, c in zip(rows, _group_matching(local, len(names), penalty)):
            out[r] = None if c is None else names[c]
    return out


def _settled(costs: list[dict[int, int]], penalty: int) -> list[int | None] | None:
    """The sum of the rows' least costs bounds every matching, so if it is reached once, that is it."""
    out: list[int | None] = []
    taken: set[int] = set()
    for own in costs:
        best, at, again = penalty, None, False
        for c, x in own.items():
            if x < best:
                best, at, again = x, c, False
            elif x == best:
                again = True
        if again or at in taken:
            return None
        if at is not None:
            taken.add(at)
        out.append(at)
    return out


def _groups(costs: list[dict[int, int]]) -> list[tuple[list[int], dict[int, int]]]:
    """Rows that share columns, directly or through others, with their columns numbered in order."""
    by_column: dict[int, list[int]] = {}
    for r, own in enumerate(costs):
        for c in own:
            by_column.setdefault(c, []).append(r)
    seen: set[int] = set()
    out = []
    for first in range(len(costs)):
        if first in seen:
            continue
        seen.add(first)
        rows, columns, todo = [], set(), [first]
        while todo:
            r = todo.pop()
            rows.append(r)
            for c in costs[r].keys() - columns:
                columns.add(c)
                for other in by_column[c]:
                    if other not in seen:
                        seen.add(other)
                        todo.append(other)
        out.append((sorted(rows), {c: k for k, c in enumerate(sorted(columns))}))
    return out


def _group_matching(costs: list[dict[int, int]], n_columns: int, penalty: int) -> list[int | None]:
    # Row r's own column for staying unmatched is n_columns + r.
    edges = [[(n_columns + r, penalty), *sorted(own.items())] for r, own in enumerate(costs)]
    matched, row_price, column_price = _optimum(edges, n_columns + len(costs))
    tight = [[c for c, x in own if x == row_price[r] + column_price[c]] for r, own in enumerate(edges)]
    chosen = _first_in_order(tight, matched, [x == 0 for x in column_price])
    return [None if c >= n_columns else c for c in chosen]


def _optimum(edges: list[list[tuple[int, int]]], n_columns: int) -> tuple[list[int], list[int], list[int]]:
    """Columns of the rows, and prices under which no edge costs less than its two ends and matched ones cost the same.

    Column prices are never above 0, and 0 where a column is free.
    """
    u, v = [0] * len(edges), [0] * n_columns
    owner: list[int | None] = [None] * n_columns
    matched = [-1] * len(edges)
    for start in range(len(edges)):
        dist: dict[int, int] = {}
        came: dict[int, int] = {}
        done: set[int] = set()
        row, far = start, 0
        while True:
            for c, x in edges[row]:
                if c not in done and ((d := far + x - u[row] - v[c]) < dist.get(c, d + 1)):
                    dist[c], came[c] = d, row
            column = min((c for c in dist if c not in done), key=lambda c: (dist[c], c))
            far = dist[column]
            done.add(column)
            if owner[column] is None:
                break
            row = owner[column]
        u[start] += far
        for c in done:
            if c != column:
                u[owner[c]] += far - dist[c]
                v[c] -= far - dist[c]
        while True:
            row = came[column]
            owner[column] = row
            matched[row], column = column, matched[row]
            if row == start:
                break
    return matched, u, v


def _first_in_order(tight: list[list[int]], matched: list[int], free_price: list[bool]) -> list[int]:
    """Of all optima, the one whose rows, in order, have the first possible column.

    A column whose price isn't 0 has an owner in every optimum; the others may stay free, which
    stands here as one more owner, -1, of any number of them.
    """
    size = len(free_price)
    order = [sorted(own, key=lambda c, r=r: (c != size - len(tight) + r, c)) for r, own in enumerate(tight)]
    owner = [-1] * size
    for r, c in enumerate(matched):
        owner[c] = r
    free = [c for c in range(size) if free_price[c]]
    for k in range(len(tight)):
        for c in order[k]:
            if c == matched[k] or _turn(k, c, order, matched, owner, free):
                break
    return matched


def _turn(k: int, wanted: int, order: list[list[int]], matched: list[int], owner: list[int], free: list[int]) -> bool:
    """Give row k the wanted column, if the rows after it can be matched around that at the same cost."""
    given_up, first = matched[k], owner[wanted]
    if first != -1 and first < k:
        return False
    came: dict[int, tuple[int, int]] = {}  # column -> the owner that moves to it, and the column that it leaves
    todo, seen = [(first, wanted)], {wanted}
    while todo:
        row, left = todo.pop()
        for c in free if row == -1 else order[row]:
            if c in seen:
                continue
            other = owner[c]
            if other != -1 and other <= k and c != given_up:
                continue
            seen.add(c)
            came[c] = (row, left)
            if c == given_up:
                while c != wanted:
                    mover, leaves = came[c]
                    owner[c] = mover
                    if mover != -1:
                        matched[mover] = c
                    c = leaves
                owner[wanted], matched[k] = k, wanted
                return True
            todo.append((other, c))
    return False
