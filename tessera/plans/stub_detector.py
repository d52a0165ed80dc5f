"""A deterministic stand-in detector for tests and the driver-table queries.

The real detector (a neural network) is a plug-in: any factory returning
``callable(pd.Series[bytes]) -> list[list[box dict]]`` works with ``score_frames``.  This stub
reads the image bytes as a small JSON document ``{"k": <int>}`` (what the driver-table frames
carry) and emits ``k % 5`` boxes whose geometry, class and confidence follow from ``k`` and the
box index, so results can be checked against SQL.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd

# Fixed values of the stand-in: class names by id, and the box geometry constants.
CLASS_NAMES = ("person", "car", "dog")
STEP_X = 1.2345
WIDTH = 10.5555
HEIGHT = 20.4444
CONF_OFFSET = 0.00375


@lru_cache(maxsize=4096)
def _boxes_for(k: int | None) -> tuple[dict, ...]:
    """Boxes for one ``k`` (memoised: they depend on ``k`` only; callers copy the dicts)."""
    if k is None:
        return ()
    base = float(k)
    out = []
    for i in range(k % 5):
        cls = (k + i) % 3
        x1 = base + i * STEP_X
        y1 = base / 2 + i
        out.append({"x1": x1, "y1": y1, "x2": x1 + WIDTH, "y2": y1 + HEIGHT,
                    "confidence": ((k + i * 7) % 100) / 100.0 + CONF_OFFSET,
                    "class_id": cls, "class_name": CLASS_NAMES[cls]})
    return tuple(out)


def _k_of(data) -> int | None:
    if data is None:
        return None
    try:
        return int(json.loads(bytes(data).decode("utf-8"))["k"])
    except (ValueError, KeyError, TypeError):
        return None


def stub_detector_factory():
    """Factory (called once per worker process) returning the detector."""
    def detect(images: pd.Series) -> list[list[dict]]:
        return [_boxes_for(_k_of(b)) for b in images]
    return detect


def fragile_detector_factory():
    """A detector that fails as a whole when one of its images has no whole number of boxes."""
    plain = stub_detector_factory()

    def detect(images: pd.Series) -> list[list[dict]]:
        if any(_k_of(b) is None for b in images):
            raise ValueError("an image without k")
        return plain(images)
    return detect
