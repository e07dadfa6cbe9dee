"""Cheapest paths through layers of scored choices, where costs may look at three layers at once.

A path takes one choice of each layer. It pays `edge` between neighbouring layers and `bend` over three in a row, and is
paid the reward of what it takes. The state of the search is the last two choices; a layer's table holds, for each such pair,
the cheapest way to it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


@dataclass
class Lattice:
    reward: list[np.ndarray]
    edge: Callable[[int, int], np.ndarray]  # layers a, b side by side -> cost of each pair of choices
    bend: Callable[[int, int, int], np.ndarray]  # layers a, b, c in a row -> cost of each triple

    def tables(self, layers: list[int]) -> list[np.ndarray]:
        """For each layer of the row after the first: the cheapest cost of (choice before, choice here), all rewards up to here paid."""
        out: list[np.ndarray] = []
        for k in range(1, len(layers)):
            a, b = layers[k - 1], layers[k]
            came = -self.reward[a][:, None] if k == 1 else np.min(out[-1][:, :, None] + self.bend(layers[k - 2], a, b), axis=0)
            out.append(came + self.edge(a, b) - self.reward[b][None])
        return out

    def back(self, layers: list[int], tables: list[np.ndarray], last: tuple[int, int]) -> list[int]:
        """The choices of the row, given those of its last two layers."""
        path = [last[1], last[0]]
        for k in range(len(layers) - 1, 1, -1):
            ways = tables[k - 2][:, path[-1]] + self.bend(layers[k - 2], layers[k - 1], layers[k])[:, path[-1], path[-2]]
            path.append(int(np.argmin(ways)))
        return path[::-1]

    def cost(self, path: list[int]) -> float:
        """What a path pays, less what it is paid."""
        n = len(path)
        total = -sum(float(r[k]) for r, k in zip(self.reward, path, strict=True))
        total += sum(float(self.edge(k, k + 1)[path[k], path[k + 1]]) for k in range(n - 1))
        return total + sum(float(self.bend(k, k + 1, k + 2)[path[k], path[k + 1], path[k + 2]]) for k in range(n - 2))

    def best(self) -> list[int]:
        layers = list(range(len(self.reward)))
        if len(layers) < 2:
            return [int(np.argmax(r)) for r in self.reward]
        tables = self.tables(layers)
        return self.back(layers, tables, _least(tables[-1]))

    def through(self, anchor: int) -> list[int]:
        """The cheapest path, found from the anchor's layer outwards: both halves' tables meet there, and its reward counts once."""
        n = len(self.reward)
        if n < 2 or anchor in (0, n - 1):
            return self.best()
        left, right = list(range(anchor + 1)), list(range(n - 1, anchor - 1, -1))
        to_left, to_right = self.tables(left), self.tables(right)
        joint = to_left[-1][:, :, None] + to_right[-1].T[None] + self.reward[anchor][None, :, None] + self.bend(anchor - 1, anchor, anchor + 1)
        i, j, k = np.unravel_index(int(np.argmin(joint)), joint.shape)
        return self.back(left, to_left, (int(i), int(j))) + self.back(right, to_right, (int(k), int(j)))[-2::-1]


def _least(table: np.ndarray) -> tuple[int, int]:
    i, j = np.unravel_index(int(np.argmin(table)), table.shape)
    return int(i), int(j)


def boundaries(x: np.ndarray, rows: list[np.ndarray], reward: list[np.ndarray], height: int, spacing: float, position: float, slope: float, thickness: float | None = None) -> Lattice:
    """Choices are tuples of rows (a column each, e.g. top and bottom) at positions x.

    An edge pays the rows' jumps and the change of the distance between first and last, a bend the change of slope.
    """
    thickness = position / 2 if thickness is None else thickness

    def edge(a: int, b: int) -> np.ndarray:
        jump = rows[b][None] - rows[a][:, None]
        far = height * max(1.0, abs(x[b] - x[a]) / spacing)
        return (position * np.abs(jump).sum(-1) + thickness * np.abs(jump[..., -1] - jump[..., 0])) / far

    def bend(a: int, b: int, c: int) -> np.ndarray:
        before, after = (rows[b][None] - rows[a][:, None]) / (x[b] - x[a]), (rows[c][None] - rows[b][:, None]) / (x[c] - x[b])
        return slope * spacing / height * np.abs(after[None] - before[:, :, None]).sum(-1)

    return Lattice(reward, edge, bend)
