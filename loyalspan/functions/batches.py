"""Model formulas over a batch of rows, as arrays.

The likelihoods are asked for at many points per row and pass, so they are worked out on arrays inside
the tasks. What depends on one column only is worked out once for each of its distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

import numpy as np

Formula = Callable[[np.ndarray], np.ndarray]


class Rows:
    """Columns of a batch. As in SQL, a logarithm outside its domain makes the value of a row unknown."""

    def __init__(self, columns: Mapping[str, np.ndarray]):
        self.columns = columns
        self.distinct = {name: np.unique(column, return_inverse=True) for name, column in columns.items()}
        self.size = len(next(iter(columns.values())))
        self.start()

    def start(self) -> None:
        """Forget what was unknown at the last point."""
        self.unknown = np.zeros(self.size, dtype=bool)

    def each(self, name: str, formula: Formula) -> np.ndarray:
        """``formula`` of one column."""
        values, at = self.distinct[name]
        return formula(values)[at]

    def _outside(self, bad: np.ndarray, name: str | None) -> None:
        if bad.any():
            self.unknown |= bad if name is None else bad[self.distinct[name][1]]

    def ln(self, name: str, formula: Formula) -> np.ndarray:
        """The logarithm of ``formula`` of one column."""
        values, at = self.distinct[name]
        inside = formula(values)
        self._outside(inside <= 0, name)
        return np.log(inside)[at]

    def ln_gamma(self, name: str, formula: Formula) -> np.ndarray:
        """Log-gamma of ``formula`` of one column, like :func:`sqltext.ln_gamma`."""
        values, at = self.distinct[name]
        z = formula(values)
        product = z.copy()
        for k in range(1, 8):
            product = product * (z + k)
        y = z + 8
        self._outside((y <= 0) | (product <= 0), name)
        tail = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / (y * y)) / (y * y)) / (y * y)) / y
        return ((y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - np.log(product))[at]

    def ln_of(self, values: np.ndarray) -> np.ndarray:
        self._outside(values <= 0, None)
        return np.log(values)

    def log1p_of(self, values: np.ndarray) -> np.ndarray:
        self._outside(values <= -1, None)
        return np.log1p(values)
