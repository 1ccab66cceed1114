"""Plain-Python versions of the recurrences, by hand from the published definitions: the tests' yardstick.

Each takes lists (one symbol, date order) and returns lists with None where the value is not yet defined.
"""

from __future__ import annotations

import math

MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
TEMA_N, T3_N, NATR_N, ADX_N = 30, 5, 14, 14
ADOSC_FAST, ADOSC_SLOW = 3, 10
LOWPASS_WN, LOWPASS_PAD = 0.1, 6
VOLUME_SCALE = 1e6
TINY = 1e-8


def lowpass_coefficients(wn: float = LOWPASS_WN):
    """First-order Butterworth low-pass by the bilinear transform (fs = 2):
    returns (b0, b1, a1) for ``y = b0*x + b1*x[-1] - a1*y[-1]``."""
    warped = 4.0 * math.tan(math.pi * wn / 2.0)
    b0 = warped / (4.0 + warped)
    a1 = (warped - 4.0) / (4.0 + warped)
    return b0, b0, a1


def _k(n: int) -> float:
    return 2.0 / (n + 1)


def lowpass_coefficients(wn: float = LOWPASS_WN):
    """First-order Butterworth low-pass by the bilinear transform (fs = 2):
    returns (b0, b1, a1) for ``y = b0*x + b1*x[-1] - a1*y[-1]``."""
    warped = 4.0 * math.tan(math.pi * wn / 2.0)
    b0 = warped / (4.0 + warped)
    a1 = (warped - 4.0) / (4.0 + warped)
    return b0, b0, a1


# ---------------------------------------------------------------- kernels
# Each kernel takes python lists (one symbol, date order) and returns lists
# with None where the indicator is not yet defined.


def macd(close_c):
    """MACD(12, 26, 9): (dif, dea, hist), visible from row 33."""
    n = len(close_c)
    out = [None] * n
    s = MACD_SLOW - 1
    if n <= s + MACD_SIGNAL - 1:
        return out, out, out
    kf, ks, k9 = _k(MACD_FAST), _k(MACD_SLOW), _k(MACD_SIGNAL)
    fast = sum(close_c[s - MACD_FAST + 1:s + 1]) / (100.0 * MACD_FAST)
    slow = sum(close_c[0:s + 1]) / (100.0 * MACD_SLOW)
    difs = [fast - slow]
    for t in range(s + 1, n):
        x = close_c[t] / 100.0
        fast = ((x - fast) * kf) + fast
        slow = ((x - slow) * ks) + slow
        difs.append(fast - slow)
    dif, dea, hist = [None] * n, [None] * n, [None] * n
    first = s + MACD_SIGNAL - 1
    acc = 0.0
    for v in difs[:MACD_SIGNAL]:
        acc = acc + v
    sig = acc / float(MACD_SIGNAL)
    for t in range(first, n):
        d = difs[t - s]
        if t > first:
            sig = ((d - sig) * k9) + sig
        dif[t], dea[t], hist[t] = d, sig, d - sig
    return dif, dea, hist


def _ema_series(x, start, period):
    """Library EMA of a float series defined from index ``start``: seeded with
    the sequential mean of x[start..start+period-1]; returns (first, values)."""
    k = _k(period)
    first = start + period - 1
    if first >= len(x):
        return first, []
    acc = 0.0
    for v in x[start:first + 1]:
        acc = acc + v
    e = acc / float(period)
    vals = [e]
    for t in range(first + 1, len(x)):
        e = ((x[t] - e) * k) + e
        vals.append(e)
    return first, vals


def tema(close_c):
    """TEMA(30) = e3 + (3*e1 - 3*e2), visible from row 87."""
    n = len(close_c)
    out = [None] * n
    p = TEMA_N
    if n < 3 * p - 2:
        return out
    k = _k(p)
    e1 = sum(close_c[:p]) / (100.0 * p)
    s1 = [e1]
    for t in range(p, n):
        e1 = ((close_c[t] / 100.0 - e1) * k) + e1
        s1.append(e1)
    f2, s2 = _ema_series(s1, 0, p)
    f3, s3 = _ema_series(s2, 0, p)
    base = p - 1
    for j, e3 in enumerate(s3):
        t = base + f2 + f3 + j
        a = s1[f2 + f3 + j]
        b = s2[f3 + j]
        out[t] = e3 + ((3.0 * a) - (3.0 * b))
    return out


def t3(close_c):
    """T3(5, vfactor=0) = triple EMA5 with the library's seeding, from row 24."""
    n = len(close_c)
    out = [None] * n
    p = T3_N
    if n < 6 * (p - 1) + 1:
        return out
    k, k1 = _k(p), 1.0 - _k(p)
    x = [c / 100.0 for c in close_c]
    e1 = sum(close_c[:p]) / (100.0 * p)
    t = p
    acc = e1
    for _ in range(p - 1):
        e1 = (k * x[t]) + (k1 * e1)
        acc = acc + e1
        t += 1
    e2 = acc / p
    acc = e2
    for _ in range(p - 1):
        e1 = (k * x[t]) + (k1 * e1)
        e2 = (k * e1) + (k1 * e2)
        acc = acc + e2
        t += 1
    e3 = acc / p
    first = 6 * (p - 1)
    while t < n:
        e1 = (k * x[t]) + (k1 * e1)
        e2 = (k * e1) + (k1 * e2)
        e3 = (k * e2) + (k1 * e3)
        if t >= first:
            out[t] = e3
        t += 1
    return out


def _true_range(h, l, pc):
    return max(h - l, abs(h - pc), abs(l - pc))


def natr(high_c, low_c, close_c):
    """NATR(14) = 100 * ATR / close, Wilder ATR seeded by the mean TR of rows 1-14."""
    n = len(close_c)
    out = [None] * n
    p = NATR_N
    if n <= p:
        return out
    trs = [None] + [_true_range(high_c[t], low_c[t], close_c[t - 1]) for t in range(1, n)]
    atr = sum(trs[1:p + 1]) / float(p)
    for t in range(p, n):
        if t > p:
            atr = ((atr * (p - 1)) + trs[t]) / float(p)
        out[t] = (atr / close_c[t]) * 100.0 if close_c[t] != 0 else 0.0
    return out


def ad_terms(high_c, low_c, close_c, volume):
    """Accumulation/distribution increments (volume in millions)."""
    out = []
    for h, l, c, v in zip(high_c, low_c, close_c, volume):
        r = h - l
        out.append(float((c - l) - (h - c)) / r * (v / VOLUME_SCALE) if r > 0 else 0.0)
    return out


def adosc(high_c, low_c, close_c, volume):
    """ADOSC(3, 10): EMA3(AD) - EMA10(AD), both seeded with the first AD; from row 9."""
    n = len(close_c)
    out = [None] * n
    if n == 0:
        return out
    kf, ks = _k(ADOSC_FAST), _k(ADOSC_SLOW)
    terms = ad_terms(high_c, low_c, close_c, volume)
    ad = 0.0 + terms[0]
    fast = slow = ad
    for t in range(1, n):
        ad = ad + terms[t]
        fast = (kf * ad) + ((1.0 - kf) * fast)
        slow = (ks * ad) + ((1.0 - ks) * slow)
        if t >= ADOSC_SLOW - 1:
            out[t] = fast - slow
    return out


def _dm(h, ph, l, pl):
    dp, dm = h - ph, pl - l
    if dm > 0 and dp < dm:
        return 0, dm
    if dp > 0 and dp > dm:
        return dp, 0
    return 0, 0


def adx(high_c, low_c, close_c):
    """ADX(14) and ADXR(14) with Wilder smoothing; ADX from row 27, ADXR from 40."""
    n = len(close_c)
    adx_out, adxr_out = [None] * n, [None] * n
    p = ADX_N
    if n < 2 * p:
        return adx_out, adxr_out
    pdm = mdm = tr = 0.0
    for t in range(1, p):
        dp, dm = _dm(high_c[t], high_c[t - 1], low_c[t], low_c[t - 1])
        pdm, mdm = pdm + dp, mdm + dm
        tr = tr + _true_range(high_c[t], low_c[t], close_c[t - 1])

    def step(t, pdm, mdm, tr):
        dp, dm = _dm(high_c[t], high_c[t - 1], low_c[t], low_c[t - 1])
        pdm = (pdm - (pdm / p)) + dp
        mdm = (mdm - (mdm / p)) + dm
        tr = (tr - (tr / p)) + _true_range(high_c[t], low_c[t], close_c[t - 1])
        dx = None
        if not (-TINY < tr < TINY):
            mdi = 100.0 * (mdm / tr)
            pdi = 100.0 * (pdm / tr)
            s = mdi + pdi
            if not (-TINY < s < TINY):
                dx = 100.0 * (abs(mdi - pdi) / s)
        return pdm, mdm, tr, dx

    sum_dx = 0.0
    for t in range(p, 2 * p):
        pdm, mdm, tr, dx = step(t, pdm, mdm, tr)
        if dx is not None:
            sum_dx = sum_dx + dx
    a = sum_dx / p
    adx_out[2 * p - 1] = a
    for t in range(2 * p, n):
        pdm, mdm, tr, dx = step(t, pdm, mdm, tr)
        if dx is not None:
            a = ((a * (p - 1)) + dx) / p
        adx_out[t] = a
    for t in range(2 * p - 1 + p - 1, n):
        adxr_out[t] = (adx_out[t] + adx_out[t - (p - 1)]) / 2.0
    return adx_out, adxr_out


def sar(high_c, low_c):
    """Parabolic SAR with acceleration 0 and maximum 0 (integer cents).

    With zero acceleration the stop moves only by clamping to the two latest
    lows (long) / highs (short) and by reversal to the extreme point."""
    n = len(high_c)
    out = [None] * n
    if n < 2:
        return out
    dp, dm = high_c[1] - high_c[0], low_c[0] - low_c[1]
    is_long = not (dm > 0 and dp < dm)
    if is_long:
        ep, stop = high_c[1], low_c[0]
    else:
        ep, stop = low_c[1], high_c[0]
    new_low, new_high = low_c[1], high_c[1]
    for t in range(1, n):
        prev_low, prev_high = new_low, new_high
        new_low, new_high = low_c[t], high_c[t]
        if is_long:
            if new_low <= stop:
                is_long = False
                stop = max(ep, prev_high, new_high)
                out[t] = stop
                ep = new_low
                stop = max(stop, prev_high, new_high)
            else:
                out[t] = stop
                if new_high > ep:
                    ep = new_high
                stop = min(stop, prev_low, new_low)
        else:
            if new_high >= stop:
                is_long = True
                stop = min(ep, prev_low, new_low)
                out[t] = stop
                ep = new_high
                stop = min(stop, prev_low, new_low)
            else:
                out[t] = stop
                if new_low < ep:
                    ep = new_low
                stop = max(stop, prev_high, new_high)
    return out


def lowpass(x, wn: float = LOWPASS_WN, pad: int = LOWPASS_PAD):
    """Zero-phase first-order low-pass (forward-backward, odd padding)."""
    n = len(x)
    if n <= pad:
        return [None] * n
    b0, b1, a1 = lowpass_coefficients(wn)
    front = [2.0 * x[0] - x[i] for i in range(pad, 0, -1)]
    back = [2.0 * x[-1] - x[n - 2 - i] for i in range(pad)]
    ext = front + list(x) + back

    def run(seq):
        z = (1.0 - b0) * seq[0]
        ys = []
        for v in seq:
            y = (b0 * v) + z
            z = (b1 * v) - (a1 * y)
            ys.append(y)
        return ys

    fwd = run(ext)
    bwd = run(fwd[::-1])[::-1]
    return bwd[pad:pad + n]
