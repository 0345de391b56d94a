"""Interpolation kernels of the distance in source cells, as column expressions and on arrays."""

import numpy as np
from pyspark.sql import functions as F

CUBIC_A = -0.5  # Fixed value: Keys (1981), third-order convolution.


def linear(t):
    d = F.abs(t)
    return F.when(d < 1, 1.0 - d).otherwise(F.lit(0.0))


def cubic(t):
    d = F.abs(t)
    near = ((CUBIC_A + 2.0) * d - (CUBIC_A + 3.0)) * d * d + 1.0
    far = ((CUBIC_A * d - 5.0 * CUBIC_A) * d + 8.0 * CUBIC_A) * d - 4.0 * CUBIC_A
    return F.when(d <= 1, near).when(d < 2, far).otherwise(F.lit(0.0))


def array_linear(t):
    return np.maximum(1.0 - np.abs(t), 0.0)


def array_cubic(t):
    d = np.abs(t)
    near = ((CUBIC_A + 2.0) * d - (CUBIC_A + 3.0)) * d * d + 1.0
    far = ((CUBIC_A * d - 5.0 * CUBIC_A) * d + 8.0 * CUBIC_A) * d - 4.0 * CUBIC_A
    return np.where(d <= 1, near, np.where(d < 2, far, 0.0))


ARRAY_KERNELS = {"bilinear": (array_linear, 1.0), "cubic": (array_cubic, 2.0)}
# Name -> (kernel, support in source cells).
KERNELS = {"bilinear": (linear, 1.0), "cubic": (cubic, 2.0)}
