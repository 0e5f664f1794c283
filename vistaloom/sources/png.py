"""A small PNG codec in numpy: grey, grey with alpha, RGB and RGBA of 8 or 16 bits, not interlaced.

Enough for masks, 16-bit depth maps and drawn images. Other formats (JPEG, palettes) are plug-ins.
"""

import struct
import zlib

import numpy as np

SIGN = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel by colour type.
SAMPLES = {0: 1, 2: 3, 4: 2, 6: 4}


def encode(image: np.ndarray) -> bytes:
    """PNG bytes of a (height, width) or (height, width, samples) array of uint8 or uint16."""
    image = image[:, :, None] if image.ndim == 2 else image
    height, width, samples = image.shape
    kind = {n: k for k, n in SAMPLES.items()}[samples]
    raw = np.ascontiguousarray(image, image.dtype.newbyteorder(">")).view(np.uint8).reshape(height, -1)
    lines = np.concatenate([np.zeros((height, 1), np.uint8), raw], axis=1).tobytes()

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", width, height, 8 * image.dtype.itemsize, kind, 0, 0, 0)
    return SIGN + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """(height, width, samples) array of uint8 or uint16; ValueError for what this codec does not read."""
    if data[:8] != SIGN:
        raise ValueError("not a PNG")
    at, head, body = 8, None, []
    while at + 8 <= len(data):
        (size,), name = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 21])
        elif name == b"IDAT":
            body.append(data[at + 8 : at + 8 + size])
        at += size + 12
    if head is None or head[2] not in (8, 16) or head[3] not in SAMPLES or head[6]:
        raise ValueError("a PNG of a kind that is not read here")
    width, height, bits, kind = head[:4]
    step = SAMPLES[kind] * bits // 8
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, 1 + width * step)
    out = np.zeros((height, width * step), np.uint8)
    above = np.zeros(width * step, np.uint8)
    for y in range(height):
        out[y] = above = _line(int(lines[y, 0]), lines[y, 1:], above, step)
    return out.view(f">u{bits // 8}").astype(f"u{bits // 8}").reshape(height, width, SAMPLES[kind])


def _line(way: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line without its filter (none, left, above, mean of both, the likeliest of three)."""
    if way == 0:
        return line
    if way == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if way == 2:
        return line + above
    if way not in (3, 4):
        raise ValueError("an unknown filter")
    left, corner, out = [0] * step, [0] * step, []
    for i, (x, b) in enumerate(zip(line.tolist(), above.tolist())):
        k = i % step
        a, c = left[k], corner[k]
        if way == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        left[k], corner[k] = (x + guess) & 255, b
        out.append(left[k])
    return np.array(out, np.uint8)
