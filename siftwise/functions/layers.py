"""Layers of a feed-forward image network in numpy, for whole batches (n, height, width, channels).

They run inside a pandas or Arrow function on weights that the user gives; no weights come with this package.
"""

from __future__ import annotations

import numpy as np


def _padded(x: np.ndarray, size: int, stride: int, padding: str, value: float) -> np.ndarray:
    if padding == "VALID":
        return x
    pads = []
    for n in x.shape[1:3]:
        total = max((-(-n // stride) - 1) * stride + size - n, 0)
        pads.append((total // 2, total - total // 2))
    return np.pad(x, ((0, 0), *pads, (0, 0)), constant_values=value)


def _windows(x: np.ndarray, size: int, stride: int) -> np.ndarray:
    """(n, rows, columns, channels, size, size)"""
    return np.lib.stride_tricks.sliding_window_view(x, (size, size), axis=(1, 2))[:, ::stride, ::stride]


def conv(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, stride: int = 1, padding: str = "SAME", groups: int = 1) -> np.ndarray:
    """weights: size x size x channels / groups x filters."""
    size = weights.shape[0]
    seen = _windows(_padded(x, size, stride, padding, 0.0), size, stride)
    parts = [np.einsum("nrcdij,ijdf->nrcf", s, w, optimize=True) for s, w in zip(np.split(seen, groups, axis=3), np.split(weights, groups, axis=3), strict=True)]
    return np.concatenate(parts, axis=3) + bias


def relu(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0)


def max_pool(x: np.ndarray, size: int, stride: int, padding: str = "VALID") -> np.ndarray:
    return _windows(_padded(x, size, stride, padding, -np.inf), size, stride).max(axis=(4, 5))


def avg_pool(x: np.ndarray, size: int, stride: int, padding: str = "VALID") -> np.ndarray:
    """Mean over what lies inside the image."""
    ones = np.ones_like(x)
    return _windows(_padded(x, size, stride, padding, 0.0), size, stride).sum(axis=(4, 5)) / _windows(_padded(ones, size, stride, padding, 0.0), size, stride).sum(axis=(4, 5))


def local_response(x: np.ndarray, radius: int = 2, alpha: float = 2e-5, beta: float = 0.75, bias: float = 1.0) -> np.ndarray:
    squares = np.pad(x * x, ((0, 0), (0, 0), (0, 0), (radius, radius)))
    total = np.lib.stride_tricks.sliding_window_view(squares, 2 * radius + 1, axis=3).sum(axis=-1)
    return x / (bias + alpha * total) ** beta


def concat(parts: list[np.ndarray], axis: int = 3) -> np.ndarray:
    return np.concatenate(parts, axis=axis)


def add(parts: list[np.ndarray]) -> np.ndarray:
    return np.sum(parts, axis=0)


def dense(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), -1) @ weights + bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def batch_norm(x: np.ndarray, mean: np.ndarray, variance: np.ndarray, scale: np.ndarray | float = 1.0, offset: np.ndarray | float = 0.0, epsilon: float = 1e-5) -> np.ndarray:
    return (x - mean) / np.sqrt(variance + epsilon) * scale + offset


def dropout(x: np.ndarray, keep: float) -> np.ndarray:
    """Of no effect when a trained network is applied."""
    return x
