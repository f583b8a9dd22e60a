"""Embedding models by name.  A model is a factory: it is called once per Python worker and
returns a function from a (batch, 3, size, size) float array to one vector per image."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Model = Callable[[np.ndarray], object]
Factory = Callable[[], Model]

PROJECTION_DIMS = 32

_REGISTRY: dict[str, Factory] = {}


def register_model(name: str, factory: Factory) -> None:
    """Make a model available under a name, e.g. ``vits16`` or ``vitl16`` with local weights."""
    _REGISTRY[name] = factory


def model_factory(name: str) -> Factory:
    if name not in _REGISTRY:
        raise ValueError(f"unknown model {name!r}; registered: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name]


def vectors_of(output: object) -> np.ndarray:
    """The embedding of a model output: the class token of a dict, the first of a tuple, or itself."""
    if isinstance(output, dict):
        output = output["x_norm_clstoken"]
    elif isinstance(output, (tuple, list)):
        output = output[0]
    return np.asarray(output, dtype=np.float32)


def projection() -> Model:
    """A fixed linear map, for runs without network weights."""
    maps: dict[int, np.ndarray] = {}

    def run(images: np.ndarray) -> np.ndarray:
        flat = np.asarray(images, dtype=np.float64).reshape(len(images), -1)
        dims = flat.shape[1]
        if dims not in maps:
            maps[dims] = np.cos(np.outer(np.arange(1, dims + 1), np.arange(1, PROJECTION_DIMS + 1))) / np.sqrt(dims)
        return flat @ maps[dims]

    return run


register_model("projection", projection)
