"""Spans of a text and the space they cover."""

from __future__ import annotations

import bisect


class Cover:
    """Disjoint intervals in order; asking and adding cost a bisection."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((s[0], s[1]) for s in spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        """Whether nothing covered lies in [a, b)."""
        at = bisect.bisect_left(self.starts, b)
        return at == 0 or self.ends[at - 1] <= a

    def take(self, a: int, b: int) -> bool:
        """Cover [a, b) if it is free; whether it was."""
        if not self.free(a, b):
            return False
        at = bisect.bisect_left(self.starts, a)
        self.starts.insert(at, a)
        self.ends.insert(at, b)
        return True


def digest_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
