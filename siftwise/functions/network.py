"""Feature extraction: image bytes to the output of a layer of a feed-forward network.

A network is a list of layers and the weights that the user's `load` gives; none come with this package. Weights are
loaded once per Python worker, images go through in blocks, so memory is the weights and one block's activations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from siftwise.functions import layers as ops
from siftwise.functions import pixels

#: Images that go through the network at once.
BLOCK = 16


@dataclass(frozen=True)
class Layer:
    """kind: conv, max_pool, avg_pool, norm (local response), dense or softmax; size and stride in pixels."""

    name: str
    kind: str
    size: int = 0
    filters: int = 0
    stride: int = 1
    groups: int = 1
    padding: str = "SAME"
    relu: bool = True


#: The network of five convolutions and three dense layers whose fc7 the features are, for 227 x 227 pixels.
IMAGE_NET = (
    Layer("conv1", "conv", 11, 96, 4, padding="VALID"),
    Layer("pool1", "max_pool", 3, stride=2, padding="VALID"),
    Layer("norm1", "norm"),
    Layer("conv2", "conv", 5, 256, groups=2),
    Layer("pool2", "max_pool", 3, stride=2, padding="VALID"),
    Layer("norm2", "norm"),
    Layer("conv3", "conv", 3, 384),
    Layer("conv4", "conv", 3, 384, groups=2),
    Layer("conv5", "conv", 3, 256, groups=2),
    Layer("pool5", "max_pool", 3, stride=2, padding="VALID"),
    Layer("fc6", "dense", filters=4096),
    Layer("fc7", "dense", filters=4096),
    Layer("fc8", "dense", filters=2089, relu=False),
    Layer("prob", "softmax"),
)


def weight_shapes(net: Sequence[Layer], crop: int = 227, channels: int = 3) -> dict[str, tuple[int, ...]]:
    """Shape of each layer's weights; its bias has the last of these numbers."""
    shapes, side = {}, crop
    for layer in net:
        if layer.kind == "conv":
            shapes[layer.name] = (layer.size, layer.size, channels // layer.groups, layer.filters)
        elif layer.kind == "dense":
            shapes[layer.name] = (side * side * channels, layer.filters)
        if layer.kind in ("conv", "max_pool", "avg_pool"):
            side = (side - layer.size) // layer.stride + 1 if layer.padding == "VALID" else -(-side // layer.stride)
        if layer.filters:
            channels = layer.filters
            side = 1 if layer.kind == "dense" else side
    return shapes


def apply(net: Sequence[Layer], weights: dict[str, tuple[np.ndarray, np.ndarray]], x: np.ndarray, output: str) -> np.ndarray:
    """Output of the layer named, one row per image of x (n, height, width, channels)."""
    for layer in net:
        if layer.kind == "conv":
            x = ops.conv(x, *weights[layer.name], layer.stride, layer.padding, layer.groups)
        elif layer.kind == "dense":
            x = ops.dense(x, *weights[layer.name])
        elif layer.kind == "norm":
            x = ops.local_response(x)
        elif layer.kind == "softmax":
            x = ops.softmax(x)
        else:
            x = getattr(ops, layer.kind)(x, layer.size, layer.stride, layer.padding)
        if layer.kind in ("conv", "dense") and layer.relu:
            x = ops.relu(x)
        if layer.name == output:
            return x.reshape(len(x), -1)
    raise ValueError(f"no layer {output}")


_LOADED: dict[str, dict] = {}


def extractor(net: Sequence[Layer], name: str, load: Callable[[], dict], output: str = "fc7", size: int = 256, crop: int = 227, mean=0.0, decode=pixels.decode):
    """A column function from image bytes to array<float>; null where the bytes are null or no image that `decode` reads.

    `load` gives the weights, called once per Python worker for each `name` (such as the path of the weights).
    """

    @F.pandas_udf("array<float>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _LOADED:
            _LOADED[name] = load()
        for batch in batches:
            out: list = [None] * len(batch)
            for start in range(0, len(batch), BLOCK):
                images = [(i, decode(data)) for i, data in enumerate(batch.iloc[start : start + BLOCK], start)]
                images = [(i, pixels.prepared(image, size, crop, mean)) for i, image in images if image is not None]
                if images:
                    rows = apply(net, _LOADED[name], np.stack([image for _, image in images]), output)
                    for (i, _), row in zip(images, rows, strict=True):
                        out[i] = row.astype(np.float32)
            yield pd.Series(out, dtype=object)

    return features
