"""Normal distribution as column expressions: complementary error function and
inverse normal CDF from published rational approximations (Cody 1969 and Acklam,
the latter with one step of Halley's method), to about 1e-15."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cody's coefficients of erf on [0, 0.46875] and of erfc on (0.46875, 4] and above 4.
ERF_NUM = [1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3]
ERF_DEN = [1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3]
ERFC_NUM = [2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
            8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3]
ERFC_DEN = [1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3,
            4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3]
TAIL_NUM = [1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4]
TAIL_DEN = [1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3]
# Acklam's coefficients of the inverse normal CDF in the middle and in the tails, and where these begin.
PPF_NUM = [-3.969683028665376e1, 2.209460984245205e2, -2.759285104469687e2, 1.383577518672690e2, -3.066479806614716e1, 2.506628277459239e0]
PPF_DEN = [-5.447609879822406e1, 1.615858368580409e2, -1.556989798598866e2, 6.680131188771972e1, -1.328068155288572e1, 1.0]
PPF_TAIL_NUM = [-7.784894002430293e-3, -3.223964580411365e-1, -2.400758277161838e0, -2.549732539343734e0, 4.374664141464968e0, 2.938163982698783e0]
PPF_TAIL_DEN = [7.784695709041462e-3, 3.224671290700398e-1, 2.445134137142996e0, 3.754408661907416e0, 1.0]
PPF_TAIL = 0.02425


def _poly(coefficients: list[float], x: Column) -> Column:
    """Horner's scheme, highest power first."""
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def erfc(x: Column) -> Column:
    """1 - erf(x); null for null."""
    def of(x: Column) -> Column:
        y, square = F.abs(x), x * x
        near = 1 - x * _poly(ERF_NUM, square) / _poly(ERF_DEN, square)
        middle = F.exp(-square) * _poly(ERFC_NUM, y) / _poly(ERFC_DEN, y)
        far = _let(1 / square, lambda q: F.exp(-square) / y * (1 / math.sqrt(math.pi) - q * _poly(TAIL_NUM, q) / _poly(TAIL_DEN, q)))
        above = F.when(y <= 4, middle).when(y > 26.7, F.lit(0.0)).otherwise(far)
        return F.when(y <= 0.46875, near).otherwise(_let(above, lambda a: F.when(x > 0, a).when(x < 0, 2 - a)))
    return _let(x.cast("double"), of)


def normal_quantile(p: Column) -> Column:
    """The value below which a standard normal variable falls with probability
    ``p``; infinite at 0 and 1, null outside."""
    def lower(p: Column) -> Column:
        """For the lower half, where nothing cancels."""
        tail = _let(F.sqrt(-2 * F.log(p)), lambda t: _poly(PPF_TAIL_NUM, t) / _poly(PPF_TAIL_DEN, t))
        middle = _let(p - 0.5, lambda c: c * _poly(PPF_NUM, c * c) / _poly(PPF_DEN, c * c))
        return _let(F.when(p < PPF_TAIL, tail).otherwise(middle), lambda x: _let(
            (0.5 * erfc(-x / math.sqrt(2)) - p) * math.sqrt(2 * math.pi) * F.exp(x * x / 2), lambda u: x - u / (1 + x * u / 2)))

    def of(p: Column) -> Column:
        half = _let(F.least(p, 1 - p), lower)
        inside = _let(half, lambda x: F.when(p <= 0.5, x).otherwise(-x))
        return F.when(p == 0, F.lit(-math.inf)).when(p == 1, F.lit(math.inf)).when((p > 0) & (p < 1), inside)
    return _let(p.cast("double"), of)
