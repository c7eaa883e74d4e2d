"""Model documents used by tests and registered queries (made by tools/make_models.py)."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

HERE = Path(__file__).resolve().parent
MODEL_IDS = ("m1", "m1i", "m2", "m3", "m4", "m5")


@lru_cache(maxsize=None)
def model_text(model_id: str) -> str:
    return (HERE / f"{model_id}.json").read_text()


def model_path(model_id: str) -> str:
    return str(HERE / f"{model_id}.json")
