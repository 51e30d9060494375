"""Model-input transforms of RGB arrays in numpy: seeded augmentation for training, a fixed crop for the rest."""

from __future__ import annotations

import hashlib

import numpy as np

from .kernels import area_resize

# Channel means and deviations of the ImageNet training images.
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def normalise(x: np.ndarray, mean: tuple[float, ...] = MEAN, std: tuple[float, ...] = STD) -> np.ndarray:
    """Bytes (height, width, 3) to floats (3, height, width), centred and scaled by channel."""
    scaled = (x.astype(np.float32) / 255 - np.asarray(mean, np.float32)) / np.asarray(std, np.float32)
    return np.ascontiguousarray(scaled.transpose(2, 0, 1))


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    return np.clip(np.rint(area_resize(x, height, width)), 0, 255).astype(np.uint8)


def center_crop(x: np.ndarray, height: int, width: int) -> np.ndarray:
    top, left = max(0, (x.shape[0] - height) // 2), max(0, (x.shape[1] - width) // 2)
    return x[top : top + height, left : left + width]


def rotate(x: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about the centre, nearest pixel, black outside."""
    h, w = x.shape[:2]
    a = np.deg2rad(degrees)
    yy, xx = np.mgrid[:h, :w]
    dy, dx = yy - (h - 1) / 2, xx - (w - 1) / 2
    sy = np.rint(np.cos(a) * dy - np.sin(a) * dx + (h - 1) / 2).astype(int)
    sx = np.rint(np.sin(a) * dy + np.cos(a) * dx + (w - 1) / 2).astype(int)
    inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    return np.where(inside[..., None], x[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)], 0).astype(x.dtype)


def generator(image_id: str, epoch: int, seed: int = 42) -> np.random.Generator:
    """A random stream that only the image, the epoch and the seed decide, so any worker gives the same result."""
    return np.random.default_rng(int.from_bytes(hashlib.sha256(f"{seed}:{epoch}:{image_id}".encode()).digest()[:8], "big"))


def train(x: np.ndarray, rng: np.random.Generator, size: tuple[int, int] = (224, 224), pad: int = 8, flip: float = 0.5, turn: float = 15.0) -> np.ndarray:
    """Resize, random crop of the padded image, flip, rotation, normalise."""
    h, w = size
    padded = np.pad(resize(x, h, w), ((pad, pad), (pad, pad), (0, 0)))
    top, left = rng.integers(0, 2 * pad + 1, size=2)
    out = padded[top : top + h, left : left + w]
    if rng.random() < flip:
        out = out[:, ::-1]
    return normalise(rotate(out, float(rng.uniform(-turn, turn))))


def evaluate(x: np.ndarray, size: tuple[int, int] = (224, 224), resized: int = 256) -> np.ndarray:
    """Resize, centre crop, normalise: for validation and inference alike."""
    return normalise(center_crop(resize(x, max(resized, size[0]), max(resized, size[1])), *size))
