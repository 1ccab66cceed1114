"""Hand vectors for the recurrence kernels (no Spark needed)."""

import math

import plain_kernels as R


def const(n, v=1000):
    return [v] * n


def test_short_series_give_nothing():
    assert R.macd(const(33)) == ([None] * 33,) * 3
    assert R.tema(const(87)) == [None] * 87
    assert R.t3(const(24)) == [None] * 24
    assert R.natr(const(14), const(14), const(14)) == [None] * 14
    assert R.adx(const(27), const(27), const(27)) == ([None] * 27, [None] * 27)
    assert R.lowpass([1.0] * 6) == [None] * 6


def test_macd_constant_is_zero_and_starts_at_row_33():
    dif, dea, hist = R.macd(const(60))
    assert all(v is None for v in dif[:33])
    assert dif[33] == 0.0 and dea[33] == 0.0 and hist[33] == 0.0
    assert all(abs(v) < 1e-12 for v in hist[33:])


def test_macd_linear_series_positive_dif():
    c = [10000 + 10 * i for i in range(80)]
    dif, dea, hist = R.macd(c)
    assert dif[40] > 0 and dea[40] > 0


def test_tema_and_t3_of_constant_are_constant():
    t = R.tema(const(120, 2500))
    assert t[86] is None and abs(t[87] - 25.0) < 1e-12
    t3 = R.t3(const(40, 2500))
    assert t3[23] is None and abs(t3[24] - 25.0) < 1e-12


def test_natr_constant_range():
    n = 30
    high, low, close = const(n, 1010), const(n, 990), const(n, 1000)
    out = R.natr(high, low, close)
    assert out[13] is None
    assert abs(out[14] - 2.0) < 1e-12 and abs(out[-1] - 2.0) < 1e-12


def test_adosc_zero_range_is_zero():
    out = R.adosc(const(20), const(20), const(20), const(20, 10 ** 6))
    assert out[8] is None and out[9] == 0.0


def test_adx_all_up_is_100():
    n = 60
    high = [1000 + 10 * i for i in range(n)]
    low = [990 + 10 * i for i in range(n)]
    close = [995 + 10 * i for i in range(n)]
    adx, adxr = R.adx(high, low, close)
    assert adx[26] is None and abs(adx[27] - 100.0) < 1e-9
    assert adxr[39] is None and abs(adxr[40] - 100.0) < 1e-9


def test_sar_long_then_reversal():
    high = [100, 105, 110, 115, 120, 90]
    low = [95, 100, 105, 110, 115, 80]
    out = R.sar(high, low)
    assert out[0] is None
    assert out[1] == 95  # long: stop starts at the first low
    assert out[4] <= 110
    assert out[5] == 120  # reversal: stop jumps to the extreme point


def test_lowpass_constant_and_linear():
    assert all(abs(v - 5.0) < 1e-12 for v in R.lowpass([5.0] * 30))
    ramp = [float(i) for i in range(80)]
    out = R.lowpass(ramp)
    # zero phase: no lag in the interior; end transients decay as a1**k
    assert max(abs(a - b) for a, b in zip(out[30:50], ramp[30:50])) < 1e-3


def test_lowpass_coefficients():
    b0, b1, a1 = R.lowpass_coefficients()
    assert math.isclose(b0, 0.136728736, rel_tol=1e-8) and b0 == b1
    assert math.isclose(a1, -0.726542528, rel_tol=1e-8)
