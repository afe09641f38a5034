"""Wagner-Fischer alignment of turns to the alternating role string `(s?(ua)+)?`, block by block.

What is put out so far is one of four states: nothing (0), a system turn (1), an assistant turn last (2), a user turn last
(3). For each state before and after a block of turns, every feasible length of the target between them is a cell of a
Wagner-Fischer table, whose columns are the remaining target characters; a target that ends alike shares its table. An
Ukkonen band keeps the cells that can lie on a path no dearer than the incumbent, which keeps and reroles along the
diagonal. The lengths of least cost are traced back, least letter first, and their audits compared.

An audit's letters decide the states between them, and insertions stand before a turn, so no cheapest audit of a block
begins another one; hence blocks can be chained by their costs, and the least audits of the blocks give the least audit.
"""

from __future__ import annotations

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: A turn's code: the place of its role's initial in "sua" (3: none of them), and flags.
OTHER, CUT, FORCED = 3, 4, 8
NONE, SYSTEM, ASSISTANT, USER = range(4)
FAR = 1 << 60
#: What ends a conversation after each state: cost and letters.
END_COSTS, END_LETTERS = [0, 2 * INSERT, 0, INSERT], ["", "II", "", "I"]
BLOCK = 64


def code_of(role: str, cut: bool, forced: bool) -> int:
    return ("sua".find(role[0]) if role and role[0] in "sua" else OTHER) + CUT * cut + FORCED * forced


class Block:
    """The tables of some turns' codes. `tables[last][i][k]`: turns i.. against the last k roles of the alternating string that ends in `last` (1 user, 2 assistant)."""

    def __init__(self, codes: list[int]):
        self.codes = codes
        m = len(codes)
        alive, cut = [0] * (m + 1), [0] * (m + 1)
        for i in range(m - 1, -1, -1):
            live = codes[i] < FORCED
            alive[i], cut[i] = alive[i + 1] + live, cut[i + 1] + (live and codes[i] >= CUT)
        slack = self._slack([c & 3 for c in codes if c < FORCED])
        self.tables = {}
        for last in (1, 2):
            below = {0: 0}
            rows = [below]
            for i in range(m - 1, -1, -1):
                code, r = codes[i], alive[i]
                role, extra, free = code & 3, TRUNCATED if code & CUT else 0, code < FORCED
                fewest = r - (slack if slack <= cut[i] else cut[i] + (slack - cut[i]) // DELETE)
                row = {0: DELETE * (m - i)}
                before = row[0]
                get = below.get
                for k in range(1, r + slack // INSERT + 1):
                    if k < fewest:
                        before = FAR
                        continue
                    best = get(k, FAR) + DELETE
                    if before + INSERT < best:
                        best = before + INSERT
                    if free:
                        wanted = last if k & 1 else 3 - last
                        step = get(k - 1, FAR) + extra + (KEEP if role == wanted else REROLE)
                        if step < best:
                            best = step
                    before = best
                    if best < FAR:
                        row[k] = best
                rows.append(row)
                below = row
            self.tables[last] = rows[::-1]

    @staticmethod
    def _slack(roles: list[int]) -> int:
        """How far the incumbents of all pairs of states lie above what the turns cost at least."""
        r = len(roles)
        from_user = REROLE * sum(role != 1 + (k & 1) for k, role in enumerate(roles))
        from_assistant = REROLE * sum(role != 2 - (k & 1) for k, role in enumerate(roles))
        if not r:
            return 2 * INSERT
        worst = 0
        for own, other in ((from_user, from_assistant), (from_assistant, from_user)):
            worst = max(worst, min(own, other + INSERT + DELETE), min(other + INSERT, own + 2 * INSERT + DELETE))
        return worst

    def _after_system(self, last: int | None) -> list[dict[int, int]]:
        """As `tables[last]`, with a kept system turn before the k roles; without `last` nothing follows it."""
        m = len(self.codes)
        rows: list[dict[int, int]] = [{}]
        for i in range(m - 1, -1, -1):
            row = {k: v + DELETE for k, v in rows[-1].items()}
            if self.codes[i] in (0, CUT):
                kept = TRUNCATED if self.codes[i] else KEEP
                follow = {0: DELETE * (m - i - 1)} if last is None else {k: v for k, v in self.tables[last][i + 1].items() if k and (k & 1) == (last == 1)}
                for k, v in follow.items():
                    row[k] = min(row.get(k, FAR), kept + v)
            rows.append(row)
        return rows[::-1]

    def ways(self, entry: int, leave: int) -> list[tuple[int, int, bool]]:
        """(cost, length, with a system turn first) of each feasible target between two states."""
        found = []
        if entry == leave:
            found.append((DELETE * len(self.codes), 0, False))
        if leave in (ASSISTANT, USER):
            last = 2 if leave == ASSISTANT else 1
            odd = (entry == USER) == (leave == ASSISTANT)
            found += [(v, k, False) for k, v in self.tables[last][0].items() if k and (k & 1) == odd]
            if entry == NONE:
                found += [(v, k, True) for k, v in self._after_system(last)[0].items()]
        elif entry == NONE and leave == SYSTEM:
            found += [(v, k, True) for k, v in self._after_system(None)[0].items()]
        return found

    def costs(self, entry: int) -> list[int]:
        return [min((c for c, _, _ in self.ways(entry, leave)), default=FAR) for leave in range(4)]

    def audit(self, entry: int, leave: int) -> str:
        """The least of the cheapest audits between two states."""
        ways = self.ways(entry, leave)
        least = min(c for c, _, _ in ways)
        return min(self._traced(leave, k, first) for c, k, first in ways if c == least)

    def _traced(self, leave: int, k: int, system: bool) -> str:
        out, i, m = [], 0, len(self.codes)
        last = {ASSISTANT: 2, USER: 1}.get(leave)
        pending = self._after_system(last) if system else None
        while i < m:
            if pending is not None:
                if pending[i + 1].get(k, FAR) + DELETE == pending[i][k]:
                    out.append("D")
                else:
                    out.append("K")
                    pending = None
                i += 1
            elif not k:
                out.append("D")
                i += 1
            else:
                table = self.tables[last]
                need = table[i][k]
                if table[i + 1].get(k, FAR) + DELETE == need:
                    out.append("D")
                    i += 1
                elif table[i].get(k - 1, FAR) + INSERT == need:
                    out.append("I")
                    k -= 1
                else:
                    out.append("K" if self.codes[i] & 3 == (last if k & 1 else 3 - last) else "R")
                    i += 1
                    k -= 1
        return "".join(out)


def blocks(codes: list[int]) -> list[list[int]]:
    return [codes[i : i + BLOCK] for i in range(0, len(codes), BLOCK)]


def run_costs(codes: list[int]) -> list[list[int]]:
    """The least cost of a run of turns between each two states."""
    total = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for part in blocks(codes):
        block = Block(part)
        own = [block.costs(entry) for entry in range(4)]
        total = [[min(FAR, *(row[k] + own[k][j] for k in range(4))) for j in range(4)] for row in total]
    return total


def run_audit(codes: list[int], entries: tuple[int, ...], after: list[int]) -> list[tuple[str, int]]:
    """(audit, state after it) of a run for each entry, the least of the cheapest, where `after` is what the rest costs from each state."""
    parts = blocks(codes)
    kept = Block(parts[0]) if len(parts) == 1 else None
    costs = [[(kept or Block(part)).costs(entry) for entry in range(4)] for part in parts] if len(parts) != 1 else [[kept.costs(e) if e in entries else [FAR] * 4 for e in range(4)]]
    rest = [after]
    for own in reversed(costs):
        rest.append([min(FAR, *(own[e][x] + rest[-1][x] for x in range(4))) for e in range(4)])
    rest.reverse()
    out = []
    for entry in entries:
        letters, state = [], entry
        for n, part in enumerate(parts):
            block = kept or Block(part)
            best = rest[n][state]
            audit, state = min((block.audit(state, x), x) for x in range(4) if costs[n][state][x] + rest[n + 1][x] == best)
            letters.append(audit)
        out.append(("".join(letters), state))
    return out
