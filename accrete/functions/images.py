"""Image fingerprint pieces used inside tasks: luma, Lanczos shrink, difference hash.

Spark reads and partitions the images; these numpy helpers work on one image at a time.
"""

from __future__ import annotations

import functools
import io

import numpy as np

from accrete.functions.hashing import HASH_COLUMNS, HASH_ROWS

# Integer luma weights (ITU-R 601 scaled to 2^16) and the filter's reach.
LUMA_RED, LUMA_GREEN, LUMA_BLUE = 19595, 38470, 7471
LANCZOS_LOBES = 3
WEIGHT_BITS = 22


def luma(red: np.ndarray, green: np.ndarray, blue: np.ndarray) -> np.ndarray:
    total = LUMA_RED * red.astype(np.int64) + LUMA_GREEN * green.astype(np.int64) + LUMA_BLUE * blue.astype(np.int64)
    return (total + (1 << 15)) >> 16


@functools.lru_cache(maxsize=256)
def lanczos_weights(source: int, target: int) -> np.ndarray:
    """Integer weights (target x source) of an anti-aliased Lanczos resize along one axis."""
    scale = source / target
    stretch = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    first = np.maximum((centre - LANCZOS_LOBES * stretch + 0.5).astype(int), 0)
    last = np.minimum((centre + LANCZOS_LOBES * stretch + 0.5).astype(int), source)
    at = np.arange(source)
    x = (at[None, :] - centre[:, None] + 0.5) / stretch
    weights = np.where(np.abs(x) < LANCZOS_LOBES, np.sinc(x) * np.sinc(x / LANCZOS_LOBES), 0.0)
    weights[(at[None, :] < first[:, None]) | (at[None, :] >= last[:, None])] = 0.0
    weights /= weights.sum(axis=1, keepdims=True)
    return np.trunc(weights * (1 << WEIGHT_BITS) + np.copysign(0.5, weights)).astype(np.int64)


def shrink(gray: np.ndarray, width: int = HASH_COLUMNS, height: int = HASH_ROWS) -> np.ndarray:
    """Resize an 8-bit gray image, columns first, each pass rounded back to 8 bits."""

    def one_pass(pixels: np.ndarray, size: int) -> np.ndarray:
        if pixels.shape[1] == size:
            return pixels
        summed = pixels @ lanczos_weights(pixels.shape[1], size).T + (1 << (WEIGHT_BITS - 1))
        return np.clip(summed >> WEIGHT_BITS, 0, 255)

    wide = one_pass(gray.astype(np.int64), width)
    return one_pass(wide.T, height).T


def hash_gray(gray: np.ndarray) -> int:
    """64-bit difference hash of a gray image, as the signed integer of the same bits."""
    small = shrink(gray)
    bits = np.packbits(small[:, 1:] > small[:, :-1])
    return int(bits.view(">i8")[0])


def decode_gray(data: bytes) -> np.ndarray:
    """Gray pixels of an encoded image: any format Pillow knows, binary PPM without it."""
    if data[:2] == b"P6":
        magic, size, depth, pixels = data.split(b"\n", 3)
        width, height = (int(n) for n in size.split())
        if int(depth) != 255:
            raise ValueError("only 8-bit PPM images are read")
        rgb = np.frombuffer(pixels, np.uint8, width * height * 3).reshape(height, width, 3)
        return luma(rgb[..., 0], rgb[..., 1], rgb[..., 2])
    try:
        from PIL import Image
    except ImportError as error:
        raise ValueError("decoding this image needs Pillow on the workers, or the `image` source") from error
    rgb = np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))
    return luma(rgb[..., 0], rgb[..., 1], rgb[..., 2])


def image_hash(data: bytes | None) -> int:
    """Hash of an encoded image; a missing or empty image gives 0."""
    return hash_gray(decode_gray(data)) if data else 0
