"""Signal kernels on numpy arrays: oscillators, spectra, filters, triggers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# --- fixed values: gravity, periods and damping of the spectra, angles, and the trigger's windows and thresholds ---
G = 9.81
PERIODS = (0.1, 0.2, 0.5, 1.0, 2.0)
DAMPING = 0.05
ANGLES = np.radians(np.arange(180))
STA, LTA, ON, OFF, FULL = 1.0, 10.0, 3.5, 0.5, 15.0


def oscillator(accel: np.ndarray, dt: float, period: float, damping: float = DAMPING) -> np.ndarray:
    """Relative displacement of a linear oscillator at rest, average-acceleration method.

    The step x' = M x + n (p + p') on x = (displacement, velocity) has a closed form; its eigenvalues
    are a conjugate pair, so in their basis it is one complex first-order recurrence, which is solved
    in blocks as a product with powers of the eigenvalue: no loop over samples.
    """
    a = np.asarray(accel, dtype=float)
    if len(a) == 0:
        return np.zeros(0)
    w = 2 * np.pi / period
    half = dt / 2
    implicit = np.array([[1.0, -half], [half * w * w, 1.0 + dt * damping * w]])
    explicit = np.array([[1.0, half], [-half * w * w, 1.0 - dt * damping * w]])
    step, load = np.linalg.solve(implicit, explicit), np.linalg.solve(implicit, np.array([0.0, half]))
    values, vectors = np.linalg.eig(step.astype(complex))
    lam, share = values[0], np.linalg.solve(vectors, load.astype(complex))[0]
    force = -(a[:-1] + a[1:])
    out, state, block = np.zeros(len(a)), 0j, 64
    down = lam ** np.arange(block)
    toeplitz = np.where(np.subtract.outer(np.arange(block), np.arange(block)) >= 0, lam ** np.abs(np.subtract.outer(np.arange(block), np.arange(block))), 0)
    for i in range(0, len(force), block):
        f = share * force[i : i + block]
        k = len(f)
        z = toeplitz[:k, :k] @ f + down[:k] * lam * state
        state = z[-1]
        out[i + 1 : i + 1 + k] = 2 * np.real(vectors[0, 0] * z)
    return out


def psa(accel: np.ndarray, dt: float, period: float, damping: float = DAMPING) -> float:
    u = oscillator(accel, dt, period, damping)
    return (2 * np.pi / period) ** 2 * float(np.abs(u).max()) if len(u) else 0.0


def rotd50(h1: np.ndarray, h2: np.ndarray) -> float:
    """Median over all directions of the largest projection, in blocks of samples."""
    peaks = np.zeros(len(ANGLES))
    for i in range(0, len(h1), 8192):
        np.maximum(peaks, np.abs(np.outer(np.cos(ANGLES), h1[i : i + 8192]) + np.outer(np.sin(ANGLES), h2[i : i + 8192])).max(axis=1), out=peaks)
    return float(np.median(peaks))


def sa_rotd50(h1: np.ndarray, h2: np.ndarray, dt: float, period: float, damping: float = DAMPING) -> float:
    """The oscillator is linear: its two responses are turned, not the ground motion."""
    return (2 * np.pi / period) ** 2 * rotd50(oscillator(h1, dt, period, damping), oscillator(h2, dt, period, damping))


def intensity(accel: np.ndarray, dt: float) -> tuple[float, float, float | None]:
    """Arias intensity, cumulative absolute velocity, and the time from 5 to 95 % of the energy."""
    if len(accel) == 0:
        return 0.0, 0.0, None
    energy = np.cumsum(np.asarray(accel, float) ** 2) * dt
    span = None
    if energy[-1] > 0:
        low, high = np.searchsorted(energy / energy[-1], [0.05, 0.95])
        span = round(float(high - low) * dt, 3)
    return round(float(np.pi / (2 * G) * energy[-1]), 6), round(float(np.abs(accel).sum() * dt), 4), span


def spectrum(accel: np.ndarray, dt: float) -> tuple[float | None, float | None]:
    """Dominant and amplitude-weighted mean frequency."""
    a = np.asarray(accel, float)
    if len(a) < 2:
        return None, None
    amplitude, f = np.abs(np.fft.rfft(a - a.mean())), np.fft.rfftfreq(len(a), dt)
    total = amplitude.sum()
    return (round(float(f[amplitude.argmax()]), 3), round(float((f * amplitude).sum() / total), 3)) if total > 0 else (None, None)


def _sections(corner: float, rate: float, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Second-order sections of a Butterworth high-pass, by the bilinear transform with prewarping."""
    k, out = np.tan(np.pi * corner / rate), []
    for i in range(order // 2):
        q = 2 * np.cos(np.pi * (2 * i + 1) / (2 * order))
        norm = 1 + q * k + k * k
        out.append((np.array([1, -2, 1]) / norm, np.array([1, 2 * (k * k - 1) / norm, (1 - q * k + k * k) / norm])))
    return out


@lru_cache(maxsize=256)
def _blocks(b: tuple[float, ...], a: tuple[float, ...], block: int) -> tuple[np.ndarray, np.ndarray]:
    """What every unit sample of a block, and either unit delay before it, adds to the block's output and to the delays after it."""
    step, after = np.zeros((block + 2, block)), np.zeros((block + 2, 2))
    z1, z2 = np.zeros(block + 2), np.zeros(block + 2)
    z1[block], z2[block + 1] = 1, 1
    for i in range(block):
        v = (np.arange(block + 2) == i).astype(float)
        o = b[0] * v + z1
        z1, z2 = b[1] * v - a[1] * o + z2, b[2] * v - a[2] * o
        step[:, i] = o
    after[:, 0], after[:, 1] = z1, z2
    return step, after


def _filtered(x: np.ndarray, b: np.ndarray, a: np.ndarray, block: int = 64) -> np.ndarray:
    """A second-order section from rest. A block's output is linear in its samples and the two delays before it, so blocks are matrix products and only the delays are carried on."""
    n = len(x)
    step, after = _blocks(tuple(map(float, b)), tuple(map(float, a)), block)
    rows = np.zeros((-(-n // block), block))
    rows.ravel()[:n] = x
    own, ends = rows @ step[:block], rows @ after[:block]
    held, state = np.zeros((len(rows), 2)), np.zeros(2)
    for i, e in enumerate(ends):
        held[i] = state
        state = state @ after[block:] + e
    return (own + held @ step[block:]).ravel()[:n]


def taper(x: np.ndarray, share: float = 0.05) -> np.ndarray:
    n = int(len(x) * share)
    if n == 0:
        return x
    w = np.ones(len(x))
    w[:n] = 0.5 * (1 - np.cos(np.pi * np.arange(n) / n))
    w[-n:] = w[:n][::-1]
    return x * w


def highpass(x: np.ndarray, rate: float, corner: float, order: int = 4, zero_phase: bool = True) -> np.ndarray:
    """Mean removed, ends tapered, filtered forward and (for zero phase) backward."""
    y = taper(np.asarray(x, float) - np.mean(x)) if len(x) else np.zeros(0)
    for turn in range(2 if zero_phase else 1):
        for b, a in _sections(corner, rate, order):
            y = _filtered(y, b, a)
        y = y[::-1] if zero_phase else y
    return y


def deconvolve(counts: np.ndarray, rate: float, poles: list[complex], zeros: list[complex], gain: float, water_level: float = 60.0, differentiate: int = 0) -> np.ndarray:
    """Response removed in the frequency domain; amplitudes below the water level (dB under the peak) are lifted to it."""
    n = len(counts)
    s = 2j * np.pi * np.fft.rfftfreq(2 * n, 1 / rate)
    h = np.full(len(s), gain, complex)
    for z in zeros:
        h *= s - z
    for p in poles:
        h /= np.where(s == p, 1e-30, s - p)
    size = np.abs(h)
    floor = size.max() * 10 ** (-water_level / 20)
    h = np.where(size < floor, np.where(size > 0, h / np.where(size > 0, size, 1), 1) * floor, h)
    return np.fft.irfft(np.fft.rfft(taper(counts - np.mean(counts)), 2 * n) / h * s**differentiate, 2 * n)[:n]


def sta_lta(x: np.ndarray, short: int, long: int) -> np.ndarray:
    """Ratio of mean energies of the last ``short`` and ``long`` samples; 0 until a long window is full."""
    e = np.concatenate([[0.0], np.cumsum(np.asarray(x, float) ** 2)])
    out = np.zeros(len(x))
    if short < 1 or long < short or len(x) < long:
        return out
    i = np.arange(long, len(x) + 1)
    lta = (e[i] - e[i - long]) / long
    out[long - 1 :] = np.divide((e[i] - e[i - short]) / short, lta, out=np.zeros(len(i)), where=lta > 0)
    return out


def triggers(ratio: np.ndarray, on: float = ON, off: float = OFF) -> list[tuple[int, int]]:
    """(first sample above ``on``, last sample before the ratio falls below ``off``) of each trigger."""
    out, i = [], 0
    above, below = np.flatnonzero(ratio > on), np.flatnonzero(ratio < off)
    while True:
        k = np.searchsorted(above, i)
        if k == len(above):
            return out
        start = int(above[k])
        j = np.searchsorted(below, start)
        end = int(below[j]) - 1 if j < len(below) else len(ratio) - 1
        out.append((start, end))
        i = end + 1


def confidence(ratio: np.ndarray, start: int, end: int) -> float:
    return round(float(np.clip((ratio[start : max(end, start) + 1].max() - ON) / (FULL - ON), 0, 1)), 3)


def snr_db(x: np.ndarray, pick: int, rate: float, seconds: float = 5.0) -> float | None:
    n = int(seconds * rate)
    noise, signal = np.asarray(x[max(0, pick - n) : pick], float), np.asarray(x[pick : pick + n], float)
    if len(noise) <= 10 or len(signal) <= 10:
        return None
    a, b = np.sqrt((noise**2).mean()), np.sqrt((signal**2).mean())
    return round(float(20 * np.log10(b / a)), 2) if a > 0 and b > 0 else None


def window_peaks(x: np.ndarray, pick: int, rate: float, windows: tuple[int, ...] = (1, 3, 5, 10)) -> dict[int, float]:
    """Largest amplitude within each window after the pick; windows the record does not cover are left out."""
    return {w: float(np.abs(x[pick : pick + int(w * rate)]).max()) for w in windows if pick + int(w * rate) <= len(x) and int(w * rate) > 0}


def merged(pieces: list[tuple[float, np.ndarray]], rate: float) -> tuple[np.ndarray, int]:
    """Pieces (start in seconds, samples) of one channel as one array, gaps filled by straight lines, and the number of gaps; where pieces overlap the earlier one counts."""
    pieces = sorted((p for p in pieces if len(p[1])), key=lambda p: p[0])
    if not pieces:
        return np.zeros(0), 0
    at, values, gaps, end = [], [], 0, None
    for start, x in pieces:
        first = round((start - pieces[0][0]) * rate)
        if end is not None:
            gaps += first > end
            x = x[max(0, end - first) :]
            first = max(first, end)
        at.append(first + np.arange(len(x)))
        values.append(x)
        end = max(end or 0, first + len(x))
    at, values = np.concatenate(at), np.concatenate(values)
    return np.interp(np.arange(int(at[-1]) + 1), at, values) if gaps else values, gaps


def clipped(x: np.ndarray) -> bool:
    """Many samples at the largest amplitude."""
    if len(x) < 10:
        return False
    size = np.abs(x)
    return bool(size.max() > 0 and (size >= 0.999 * size.max()).sum() > max(5, 0.01 * len(x)))


def integral(x: np.ndarray, dt: float) -> np.ndarray:
    """Running integral by trapezoids, from 0."""
    return np.concatenate([[0.0], np.cumsum((x[1:] + x[:-1]) / 2) * dt]) if len(x) else np.zeros(0)


def displacement_peaks(accel: np.ndarray, pick: int, rate: float, windows: tuple[int, ...] = (1, 3, 5, 10), corner: float = 0.075) -> dict[int, float]:
    """Peak displacement after the pick: twice integrated, filtered forward only (two corners), as it could be had in real time."""
    moved = accel - accel[:pick].mean() if pick > 0 else accel
    return window_peaks(highpass(integral(integral(moved, 1 / rate), 1 / rate), rate, corner, 2, False), pick, rate, windows)
