"""NBD purchase model (Ehrenberg 1959): customers buy at a gamma-distributed rate and never leave.

The limit of MBG/NBD at a = 0 and of Pareto/NBD at s = 0. Parameters: r, alpha.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np

from loyalspan.functions.batches import Rows

NAMES = ("r", "alpha")
COLUMNS = ("x", "T")


def row_log_likelihood(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The part of the log-likelihood that depends on the row: its x and T."""
    r, alpha = (params[name] for name in NAMES)
    x = rows.columns["x"]
    return rows.ln_gamma("x", lambda x: r + x) - (r + x) * rows.ln("T", lambda T: alpha + T)


def constant_log_likelihood(params: Mapping[str, float]) -> float:
    """The part that is the same for every row."""
    return params["r"] * math.log(params["alpha"]) - math.lgamma(params["r"])
