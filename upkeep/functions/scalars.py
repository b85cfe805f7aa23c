"""Row-level expressions on sensor readings and result tables."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from upkeep import defaults as D


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def temp_diff(air="temp_aire", process="temp_proceso") -> Column:
    """Process minus air temperature."""
    return _c(process) - _c(air)


def power_w(torque="torque", speed="vel_rotacion") -> Column:
    """Mechanical power in watts from torque [Nm] and speed [rpm]."""
    return _c(torque) * _c(speed) * F.lit(2 * math.pi / 60)


def ratio(num, den, scale: float = 1.0) -> Column:
    """num / den * scale, null where the denominator is zero."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(float(scale))


def ratio_or_zero(num, den) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def significance_stars(p) -> Column:
    p = _c(p)
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").when(p.isNotNull(), "n.s.")


def corr_strength(r) -> Column:
    """Word for a correlation; null at or below 0.3 in size, where pairs are not reported."""
    size = F.abs(_c(r))
    return F.when(size > 0.7, D.STRONG).when(size > 0.3, D.MODERATE)


def sign_tag(coef) -> Column:
    return F.when(_c(coef) > 0, "[+]").otherwise("[-]")


def verdict(flag) -> Column:
    return F.when(_c(flag), D.HOLDS).otherwise(D.FAILS)


def failure_mode_index(modes=D.MODES) -> Column:
    """0 for no flag, else the 1-based position of the last flag set in list order."""
    return F.greatest(F.lit(0), *[F.when(F.col(m) == 1, i).otherwise(0) for i, m in enumerate(modes, 1)])


def drop_meta_keys(map_col) -> Column:
    """Map without the keys that start with an underscore."""
    return F.map_filter(_c(map_col), lambda k, v: ~k.startswith("_"))


def trim_map(map_col) -> Column:
    """Map of strings with blanks stripped from keys and values."""
    return F.transform_values(
        F.transform_keys(_c(map_col), lambda k, v: F.trim(k)), lambda k, v: F.trim(v)
    )


def class_name(label, names=None) -> Column:
    names = names or D.CLASS_NAMES
    out = None
    for value, name in names.items():
        cond = _c(label) == value
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(_c(label).cast("string"))


def rounded(value, digits: int) -> Column:
    """`round(value, digits)`, the same doubles, without a decimal number for each row.

    Where the scaled value is clearly not a tie, its nearest whole number over a power of ten is the same double; ties, near
    ties, large and non-finite values are left to `round`.
    """
    value = _c(value)
    scaled = value * F.lit(10.0**digits)
    clear = (F.abs(scaled) < 1e11) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(clear, F.floor(scaled + 0.5) / F.lit(10.0**digits)).otherwise(F.round(value, digits))
