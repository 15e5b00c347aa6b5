"""Window fits over one bounded chunk of a series, vectorised with numpy."""

from __future__ import annotations

import numpy as np

BLOCK = 2048

#: Frames whose spread is below this share of the chunk's are fitted from their own values instead of running sums.
CLOSE = 1e-9


def _frames(v: np.ndarray, before: int, after: int, outside) -> np.ndarray:
    """Matrix of frames [i - before, i + after]."""
    pad = np.concatenate([np.full(before, outside, v.dtype), v, np.full(after, outside, v.dtype)])
    return np.lib.stride_tricks.sliding_window_view(pad, before + after + 1)


def window_fit(y: np.ndarray, before: int, after: int, group: np.ndarray | None = None, log_from_min: bool = False):
    """Slope, R2, present values and rows of every frame, y against its position.

    Rows of another ``group`` do not belong to the frame. With ``log_from_min`` the frame is first
    turned into log(y - min + 0.1). R2 is 0 where the frame has no spread.

    Straight fits come from running sums around the chunk's centre, so their cost doesn't depend on the width; frames
    that are nearly flat beside the rest of the chunk, and log fits, whose values change with the frame, are
    fitted frame by frame.
    """
    y = np.asarray(y, dtype="float64")
    own = np.zeros(len(y), dtype="int64") if group is None else np.unique(np.asarray(group), return_inverse=True)[1].astype("int64")
    if log_from_min or (np.diff(own) < 0).any():
        return _fit_frames(y, before, after, own, np.arange(len(y)), log_from_min)
    slope, r2, present, rows, close = _fit_sums(y, before, after, own)
    at = np.flatnonzero(close)
    if len(at):
        slope[at], r2[at], present[at], rows[at] = _fit_frames(y, before, after, own, at, False)
    return slope, r2, present, rows


def _fit_sums(y: np.ndarray, before: int, after: int, own: np.ndarray):
    n = len(y)
    i = np.arange(n)
    low = np.maximum(i - before, np.searchsorted(own, own, "left"))
    high = np.minimum(i + after + 1, np.searchsorted(own, own, "right"))
    ok = ~np.isnan(y)
    centre = y[ok].mean() if ok.any() else 0.0
    f = np.where(ok, y - centre, 0.0).astype(np.longdouble)
    x = np.where(ok, i - n // 2, 0).astype(np.longdouble)

    def total(v: np.ndarray) -> np.ndarray:
        upto = np.concatenate([np.zeros(1, v.dtype), np.cumsum(v)])
        return upto[high] - upto[low]

    m = total(ok.astype("int64"))
    div = np.maximum(m, 1)
    sx, sf = total(x), total(f)
    sxx, sxy, syy = total(x * x) - sx * sx / div, total(x * f) - sx * sf / div, total(f * f) - sf * sf / div
    close = (m > 1) & (syy <= CLOSE * max(float((f * f).sum()), 1e-300))
    flat = (m < 2) | (sxx <= 0) | close
    safe = np.where(flat, 1, sxx)
    slope = np.where(flat, 0.0, (sxy / safe).astype("float64"))
    r2 = np.where(flat, 0.0, np.minimum(1.0, (sxy * sxy / (safe * np.where(flat, 1, syy))).astype("float64")))
    return slope, r2, m.astype("float64"), (high - low).astype("float64"), close


def _fit_frames(y: np.ndarray, before: int, after: int, own: np.ndarray, at: np.ndarray, log_from_min: bool):
    n = len(at)
    slope, r2, present, rows = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    values, owners = _frames(y, before, after, np.nan), _frames(own, before, after, -1)
    x = np.arange(before + after + 1, dtype="float64") - before
    with np.errstate(all="ignore"):
        for a in range(0, n, BLOCK):
            s = slice(a, min(a + BLOCK, n))
            f = values[at[s]]
            inside = owners[at[s]] == own[at[s], None]
            ok = inside & ~np.isnan(f)
            m = ok.sum(axis=1)
            if log_from_min:
                low = np.where(ok, f, np.inf).min(axis=1, keepdims=True)
                f = np.log(np.where(ok, f - low, 0.0) + 0.1)
            f = np.where(ok, f, 0.0)
            div = np.maximum(m, 1)
            xm, ym = (ok @ x) / div, f.sum(axis=1) / div
            dx = np.where(ok, x - xm[:, None], 0.0)
            dy = np.where(ok, f - ym[:, None], 0.0)
            sxx, sxy, syy = (np.einsum("ij,ij->i", p, q) for p, q in ((dx, dx), (dx, dy), (dy, dy)))
            flat = (sxx <= 0) | (syy <= 1e-18 * np.maximum(1.0, div * ym * ym))
            slope[s] = np.where(flat, 0.0, sxy / np.where(sxx > 0, sxx, 1.0))
            r2[s] = np.where(flat, 0.0, np.minimum(1.0, sxy * sxy / np.where(flat, 1.0, sxx * syy)))
            present[s], rows[s] = m, inside.sum(axis=1)
    return slope, r2, present, rows
