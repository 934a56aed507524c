"""Derivatives of the logarithm of the gamma function, for positive numbers, by their asymptotic series."""

from __future__ import annotations

import numpy as np

#: From here on the series are exact to rounding.
_FAR = 10


def digamma(x: np.ndarray | float) -> np.ndarray:
    x = np.asarray(x, float)
    less = sum((1.0 / (x + i) for i in range(_FAR)), np.zeros_like(x))
    y = x + _FAR
    z = 1.0 / (y * y)
    series = z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z * (1 / 132 - z * 691 / 32760)))))
    return np.log(y) - 0.5 / y - series - less


def trigamma(x: np.ndarray | float) -> np.ndarray:
    x = np.asarray(x, float)
    more = sum((1.0 / (x + i) ** 2 for i in range(_FAR)), np.zeros_like(x))
    y = x + _FAR
    z = 1.0 / (y * y)
    return 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * 5 / 66)))) + more
