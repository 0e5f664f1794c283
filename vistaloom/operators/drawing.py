"""Pictures drawn in numpy and stored as PNG: marks on images, and bird's-eye maps.

No fonts are used: options and objects are told apart by colour and by order. What draws more (labels,
arrows, styles) is a plug-in (kernels.Model).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import png

#: Red, green and blue of the mark colours.
RGB = {
    "red": (255, 0, 0),
    "blue": (0, 0, 255),
    "green": (0, 255, 0),
    "pink": (255, 192, 203),
    "yellow": (255, 255, 0),
    "orange": (255, 165, 0),
    "purple": (128, 0, 128),
    "brown": (165, 42, 42),
}
#: How strongly a mask is laid over the image.
ALPHA = 0.3


def box(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: str, width: int = 2) -> None:
    """The outline of a box, its edges inside it."""
    for a, b, c, d in ((x1, y1, x2, y1 + width - 1), (x1, y2 - width + 1, x2, y2), (x1, y1, x1 + width - 1, y2), (x2 - width + 1, y1, x2, y2)):
        image[max(0, b) : max(0, d + 1), max(0, a) : max(0, c + 1)] = RGB[colour]


def point(image: np.ndarray, u: int, v: int, colour: str, radius: int = 3) -> None:
    y, x = np.ogrid[: image.shape[0], : image.shape[1]]
    image[(x - u) ** 2 + (y - v) ** 2 <= radius**2] = RGB[colour]


def mask(image: np.ndarray, on: np.ndarray, colour: str) -> None:
    """A mask laid over the image, with its edge in full colour."""
    image[on] = (image[on] * (1 - ALPHA) + np.array(RGB[colour]) * ALPHA).astype(np.uint8)
    wide = np.pad(on, 1)
    inner = wide[:-2, 1:-1] & wide[2:, 1:-1] & wide[1:-1, :-2] & wide[1:-1, 2:]
    image[on & ~inner] = RGB[colour]


def marked(images: DataFrame) -> DataFrame:
    """(path, image struct<bytes>) of rows (path, width, height, rgb, marks): marks is array<struct<kind,
    colour, x1, y1, x2, y2>>, kind "box", or "point" at (x1, y1); drawn in their order."""

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for w, h, rgb, marks in zip(pdf["width"], pdf["height"], pdf["rgb"], pdf["marks"]):
                image = np.frombuffer(rgb, np.uint8).reshape(h, w, 3).copy()
                for m in marks if marks is not None else ():
                    if m["kind"] == "point":
                        point(image, m["x1"], m["y1"], m["colour"])
                    else:
                        box(image, m["x1"], m["y1"], m["x2"], m["y2"], m["colour"])
                out.append({"bytes": png.encode(image)})
            yield pd.DataFrame({"path": pdf["path"], "image": out})

    return images.select("path", "width", "height", "rgb", "marks").mapInPandas(go, "path string, image struct<bytes:binary>")


def map_picture(cells: list, grid: int = 10, size: int = 20) -> np.ndarray:
    """A map of (kind, row, col): cells white, objects blue, cameras red (over objects), rows downwards."""
    image = np.full((grid * size + 1, grid * size + 1, 3), 255, np.uint8)
    for kind, row, col in sorted(cells, key=lambda c: c[0] == "camera"):
        image[row * size : (row + 1) * size, col * size : (col + 1) * size] = RGB["red" if kind == "camera" else "blue"]
    image[::size], image[:, ::size] = (200, 200, 200), (200, 200, 200)
    return image


def map_pictures(placed: DataFrame, keys: tuple[str, ...] = ("scene_id",), grid: int = 10, size: int = 20) -> DataFrame:
    """(keys, image struct<bytes>): a picture of each map whose entities bev.placed has placed."""
    cells = placed.groupBy(*keys).agg(F.collect_list(F.struct("kind", "row", "col")).alias("cells"))  # entities of one scene
    schema = ", ".join(f"`{k}` {placed.schema[k].dataType.simpleString()}" for k in keys)

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            drawn = [{"bytes": png.encode(map_picture([(c["kind"], c["row"], c["col"]) for c in cs], grid, size))} for cs in pdf["cells"]]
            yield pdf[list(keys)].assign(image=drawn)

    return cells.mapInPandas(go, f"{schema}, image struct<bytes:binary>")
