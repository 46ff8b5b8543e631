"""Probabilities from margins."""

from __future__ import annotations

import numpy as np


def logistic_curve(margins: np.ndarray, labels: np.ndarray, steps: int = 100, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton's method with smoothed targets.

    With ``counts``, each margin stands for as many rows, and ``labels`` says how many of them have label 1.
    """
    positive, n = labels.sum(), len(labels) if counts is None else counts.sum()
    counts = 1 if counts is None else counts
    target = labels * ((positive + 1) / (positive + 2)) + (counts - labels) * (1 / (n - positive + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g, w = counts * p - target, counts * (p * (1 - p) + 1e-9)
        ha, hb, hab = (w * margins**2).sum() + 1e-6, w.sum() + 1e-6, (w * margins).sum()
        ga, gb = (g * margins).sum(), g.sum()
        det = ha * hb - hab**2
        da, db = (hb * ga - hab * gb) / det, (ha * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a - step * da, b - step * db
        if max(abs(da), abs(db)) < 1e-6:
            break
    return float(a), float(b)
