"""Pixel measures and perceptual hashes of one RGB array (height, width, 3; uint8), in numpy."""

from __future__ import annotations

import numpy as np


def gray(rgb: np.ndarray) -> np.ndarray:
    """Luma by the ITU-R 601 weights, rounded to bytes."""
    return np.floor(rgb[..., 0] * 0.299 + rgb[..., 1] * 0.587 + rgb[..., 2] * 0.114 + 0.5).astype(np.uint8)


def area_resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over the (fractional) source area of each target pixel, as doubles."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * (n / m)
        cells = np.arange(n)
        w = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
        return np.clip(w, 0, None) * (m / n)

    rows, columns = weights(x.shape[0], height), weights(x.shape[1], width)
    return np.einsum("hi,ij...,wj->hw...", rows, x.astype(np.float64), columns, optimize=True)


def downscale(rgb: np.ndarray, longest: int) -> np.ndarray:
    """rgb with its longest side at most `longest`; smaller images stay."""
    h, w = rgb.shape[:2]
    if max(h, w) <= longest:
        return rgb
    scale = longest / max(h, w)
    return np.clip(np.rint(area_resize(rgb, max(1, round(h * scale)), max(1, round(w * scale)))), 0, 255).astype(np.uint8)


def _mirrored(x: np.ndarray) -> np.ndarray:
    """One pixel around, mirrored at the edge pixel's centre."""
    return np.pad(x.astype(np.float64), 1, mode="reflect" if min(x.shape) > 1 else "edge")


def laplacian_variance(luma: np.ndarray) -> float:
    p = _mirrored(luma)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def tenengrad(luma: np.ndarray) -> float:
    p = _mirrored(luma)
    right, left = p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:], p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2]
    down, up = p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:], p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:]
    return float(((right - left) ** 2 + (down - up) ** 2).mean())


def contrast(luma: np.ndarray, method: str = "std") -> float:
    x = luma.astype(np.float64)
    if method == "michelson":
        hi, lo = float(x.max()), float(x.min())
        return (hi - lo) / (hi + lo) * 255 if hi + lo > 0 else 0.0
    return float(np.sqrt(((x - x.mean()) ** 2).mean()))


def entropy(luma: np.ndarray) -> float:
    n = np.bincount(luma.ravel(), minlength=256)
    p = n[n > 0] / n.sum()
    return max(0.0, float(-(p * np.log2(p)).sum()))


def colourfulness(rgb: np.ndarray) -> float:
    """Hasler and Suesstrunk's measure of the opponent axes."""
    r, g, b = (rgb[..., i].astype(np.float64) for i in range(3))
    rg, yb = r - g, (r + g) / 2 - b
    return float(np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean()))


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def average_hash(luma: np.ndarray, side: int = 8) -> str:
    small = np.rint(area_resize(luma, side, side))
    return _hex(small > small.mean())


def difference_hash(luma: np.ndarray, side: int = 8) -> str:
    small = np.rint(area_resize(luma, side, side + 1))
    return _hex(small[:, 1:] > small[:, :-1])


def cosine_hash(luma: np.ndarray, side: int = 8) -> str:
    """Signs of the low DCT block against its median, which leaves the first coefficient out; its bit stays."""
    n = 4 * side
    k = np.arange(n)
    basis = np.cos(np.pi * (k[None, :] + 0.5) * k[:, None] / n) * np.sqrt(2 / n)
    basis[0] /= np.sqrt(2)
    block = (basis @ np.rint(area_resize(luma, n, n)) @ basis.T)[:side, :side]
    return _hex(block > np.median(block.ravel()[1:]))


def measure(rgb: np.ndarray, longest: int = 512, shadow: int = 16, highlight: int = 240, contrast_method: str = "std") -> dict:
    """All measures and hashes of one decoded image. Contrast is std, rms (the same) or michelson."""
    small = downscale(rgb, longest)
    luma = gray(small)
    return {
        "quality_blur_score": laplacian_variance(luma),
        "tenengrad": tenengrad(luma),
        "quality_brightness": float(luma.mean()),
        "shadow_fraction": float((luma <= shadow).mean()),
        "highlight_fraction": float((luma >= highlight).mean()),
        "quality_contrast": contrast(luma, contrast_method),
        "quality_entropy": entropy(luma),
        "quality_colorfulness": colourfulness(small),
        "average_hash": average_hash(luma),
        "difference_hash": difference_hash(luma),
        "perceptual_hash": cosine_hash(luma),
    }


def oriented(x: np.ndarray, orientation: int | None) -> np.ndarray:
    """x turned upright by its EXIF orientation (1 to 8; others leave it)."""
    turns = {2: lambda a: a[:, ::-1], 3: lambda a: a[::-1, ::-1], 4: lambda a: a[::-1], 5: lambda a: a.swapaxes(0, 1), 6: lambda a: np.rot90(a, -1), 7: lambda a: a[::-1, ::-1].swapaxes(0, 1), 8: lambda a: np.rot90(a, 1)}
    return turns[orientation](x) if orientation in turns else x
