"""Convolutional networks on blocks, forward only, in numpy: layers as a list, saved as one file, run as a `Classifier`.

Arrays are (channel, z, y, x). A convolution gives only what its kernel covers wholly, so a network's pad follows from its layers.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from .classify import Classifier


def convolved(a: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Cross-correlation with weights (out, in, z, y, x), where the kernel fits."""
    views = np.lib.stride_tricks.sliding_window_view(a, weights.shape[2:], axis=(1, 2, 3))
    return np.moveaxis(np.tensordot(views, weights, axes=((0, 4, 5, 6), (1, 2, 3, 4))), -1, 0) + bias[:, None, None, None]


def pooled(a: np.ndarray, size: Sequence[int], pick=np.max) -> np.ndarray:
    """The largest (or mean) of each block of `size`; what doesn't fill one is cut off."""
    n = [s // p for s, p in zip(a.shape[1:], size, strict=True)]
    held = a[:, : n[0] * size[0], : n[1] * size[1], : n[2] * size[2]]
    return pick(held.reshape(a.shape[0], n[0], size[0], n[1], size[1], n[2], size[2]), axis=(2, 4, 6))


def upsampled(a: np.ndarray, size: Sequence[int]) -> np.ndarray:
    for axis, s in enumerate(size, 1):
        a = a.repeat(s, axis)
    return a


def depth_to_space(a: np.ndarray, size: int) -> np.ndarray:
    """Channel size * i + j of each size ** 2 that follow one another goes to row i and column j of size x size places of one channel."""
    c, z, y, x = a.shape
    return a.reshape(c // size**2, size, size, z, y, x).transpose(0, 3, 4, 1, 5, 2).reshape(c // size**2, z, y * size, x * size)


def cropped(a: np.ndarray, by: Sequence[int]) -> np.ndarray:
    """Without `by` (z, y, x) voxels at either end."""
    return a[(slice(None), *(slice(b, n - b) for b, n in zip(by, a.shape[1:], strict=True)))]


def softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(0))
    return e / e.sum(0)


def interwoven(parts: dict[tuple[int, int, int], np.ndarray], size: Sequence[int]) -> np.ndarray:
    """One image of the results of all shifts of a pooled network, each at the places it belongs to."""
    first = parts[0, 0, 0]
    out = np.empty((first.shape[0], *(n * s for n, s in zip(first.shape[1:], size, strict=True))), first.dtype)
    for (z, y, x), a in parts.items():
        out[:, z :: size[0], y :: size[1], x :: size[2]] = a
    return out


PLAIN = {
    "relu": lambda a: np.maximum(a, 0), "sigmoid": lambda a: 1 / (1 + np.exp(-a)), "tanh": np.tanh, "softmax": softmax,
}


@dataclass
class Network:
    """Layers as dicts: conv (weights, bias), scale (gain, shift), pool, mean_pool, upsample (size), depth_to_space (size), crop (by), relu, sigmoid, tanh, softmax; keep (name) holds what is there for a later join (name), which cuts it to size and puts it in front of the channels."""

    layers: Sequence[dict]
    classes: Sequence[str]
    pad: tuple[int, int, int] = (0, 0, 0)
    mean: float = 0.0
    scale: float = 255.0
    low: float = 0.0
    high: float = 1.0
    held: dict = field(default_factory=dict, repr=False)

    def forward(self, a: np.ndarray) -> np.ndarray:
        held: dict[str, np.ndarray] = {}
        for layer in self.layers:
            kind = layer["kind"]
            if kind == "conv":
                a = convolved(a, np.asarray(layer["weights"], float), np.asarray(layer["bias"], float))
            elif kind == "scale":
                a = a * np.asarray(layer["gain"], float)[:, None, None, None] + np.asarray(layer["shift"], float)[:, None, None, None]
            elif kind in ("pool", "mean_pool"):
                a = pooled(a, layer["size"], np.max if kind == "pool" else np.mean)
            elif kind == "upsample":
                a = upsampled(a, layer["size"])
            elif kind == "depth_to_space":
                a = depth_to_space(a, layer["size"])
            elif kind == "crop":
                a = cropped(a, layer["by"])
            elif kind == "keep":
                held[layer["name"]] = a
            elif kind == "join":
                other = held[layer["name"]]
                a = np.concatenate([cropped(other, [(m - n) // 2 for m, n in zip(other.shape[1:], a.shape[1:], strict=True)])[:, : a.shape[1], : a.shape[2], : a.shape[3]], a])
            else:
                a = PLAIN[kind](a)
        return a

    def classifier(self) -> Classifier:
        """On normalised images; each class's channel is clipped to low..high and stretched to 0..255."""

        def run(image: np.ndarray, x: int, y: int, z: int) -> dict[str, np.ndarray]:
            out = self.forward(((image - self.mean) / self.scale)[None].astype(float))
            held = np.clip((out - self.low) / (self.high - self.low), 0, 1)
            return {name: np.floor(held[k] * 255 + 0.5) for k, name in enumerate(self.classes)}

        return Classifier(run, list(self.classes), self.pad)

    def save(self, path: str) -> None:
        plain = [{k: np.asarray(v).tolist() if k in ("weights", "bias", "gain", "shift") else v for k, v in layer.items()} for layer in self.layers]
        with open(path, "w") as f:
            json.dump({"layers": plain, "classes": list(self.classes), "pad": list(self.pad), "mean": self.mean, "scale": self.scale, "low": self.low, "high": self.high}, f)


_loaded: dict[tuple[str, int], Network] = {}


def load(path: str) -> Network:
    """A saved network, read once for each state of its file in a process."""
    key = (os.path.abspath(path), os.stat(path).st_mtime_ns)
    if key not in _loaded:
        with open(path) as f:
            told = json.load(f)
        _loaded[key] = Network(**told | {"pad": tuple(told["pad"])})
    return _loaded[key]


def u_net(weights: Sequence[tuple[np.ndarray, np.ndarray]], classes: Sequence[str]) -> Network:
    """A network of two levels from five convolutions (weights, bias): down, lower, up (after the join), and out."""
    (a, b), (c, d), (e, f), (g, h) = weights
    conv = lambda w, k: [{"kind": "conv", "weights": w, "bias": k}, {"kind": "relu"}]
    return Network([*conv(a, b), {"kind": "keep", "name": "upper"}, {"kind": "pool", "size": (1, 2, 2)}, *conv(c, d), {"kind": "upsample", "size": (1, 2, 2)}, {"kind": "join", "name": "upper"}, *conv(e, f), {"kind": "conv", "weights": g, "bias": h}, {"kind": "softmax"}], classes)
