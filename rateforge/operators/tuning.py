"""Adaptive parameter search: finished trials choose where the next ones are drawn.

Settings are points of the unit cube (a learning rate on a log scale). The
first trials are random. Then the finished ones are parted into the best fifth
and the rest; each part is a density, a sum of bumps at its points plus a
uniform share, and of many points drawn from the density of the best, the one
with the greatest ratio of the two densities is tried. The bumps narrow as
trials are added. Draws depend on the seed and the finished trials only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

Setting = dict
Trial = tuple[Setting, float]

#: Random trials before the densities are used, the share of best trials, and draws compared per trial.
STARTUP = 10
BEST_SHARE = 0.2
CANDIDATES = 64
WIDEST, NARROWEST = 0.35, 0.04


class Sampler:
    """Draws settings from ``space``: name -> (low, high); whole numbers if both bounds are.

    ``log`` names are drawn on a log scale; ``text`` names are given as text.
    """

    def __init__(self, space: dict[str, tuple], log: Sequence[str] = (), text: Sequence[str] = (), seed: int = 42):
        self.space, self.log, self.text, self.seed = space, set(log), set(text), seed

    def setting(self, point: Sequence[float]) -> Setting:
        """The setting at a point of the unit cube."""
        out = {}
        for (name, (low, high)), u in zip(self.space.items(), point):
            if isinstance(low, int) and isinstance(high, int):
                value = min(high, low + int(u * (high - low + 1)))
            elif name in self.log:
                value = math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
            else:
                value = low + u * (high - low)
            out[name] = repr(value) if name in self.text else value
        return out

    def point(self, setting: Setting) -> list[float]:
        """The point of a setting; whole numbers at the middle of their share."""
        out = []
        for name, (low, high) in self.space.items():
            value = float(setting[name])
            if isinstance(low, int) and isinstance(high, int):
                u = (value - low + 0.5) / (high - low + 1)
            elif name in self.log:
                u = math.log(value / low) / math.log(high / low)
            else:
                u = (value - low) / (high - low)
            out.append(min(1.0, max(0.0, u)))
        return out

    def draw(self, finished: Sequence[Trial], n: int) -> list[Setting]:
        """``n`` settings to try next."""
        drawn = random.Random(f"{self.seed}/{len(finished)}")
        # A trial without a figure (a failed or diverged fit) counts as the worst.
        ranked = sorted(finished, key=lambda t: t[1] if t[1] == t[1] else math.inf)
        out: list[Setting] = []
        while len(out) < n:
            if len(finished) < STARTUP:
                point = [drawn.random() for _ in self.space]
            else:
                points = [self.point(s) for s, _ in ranked]
                cut = max(2, round(BEST_SHARE * len(points)))
                # Trials of the same batch count among the rest, which keeps its draws apart.
                point = self._promising(drawn, points[:cut], points[cut:] + [self.point(s) for s in out])
            out.append(self.setting(point))
        return out

    def _promising(self, drawn: random.Random, best: list[list[float]], rest: list[list[float]]) -> list[float]:
        width = max(NARROWEST, WIDEST * (len(best) + len(rest)) ** -0.4 * 2)
        found, highest = [], -math.inf
        for _ in range(CANDIDATES):
            point = [self._near(drawn, [b[k] for b in best], width) for k in range(len(self.space))]
            ratio = sum(
                math.log(_density(u, [b[k] for b in best], width)) - math.log(_density(u, [r[k] for r in rest], width))
                for k, u in enumerate(point)
            )
            if ratio > highest:
                found, highest = point, ratio
        return found

    @staticmethod
    def _near(drawn: random.Random, centres: list[float], width: float) -> float:
        at = drawn.randrange(len(centres) + 1)
        if at == len(centres):
            return drawn.random()
        while True:
            u = drawn.gauss(centres[at], width)
            if 0 <= u <= 1:
                return u


def _density(u: float, centres: list[float], width: float) -> float:
    """A uniform share and a bump, cut to the unit interval, at each centre."""
    total = 1.0
    for c in centres:
        inside = (math.erf((1 - c) / (width * math.sqrt(2))) + math.erf(c / (width * math.sqrt(2)))) / 2
        total += math.exp(-(((u - c) / width) ** 2) / 2) / (width * math.sqrt(2 * math.pi) * inside)
    return total / (len(centres) + 1)
