"""Normal intervals on the log scale and their texts."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard normal quantiles at 0.95 and 0.975.
Z95 = 1.6448536269514722
Z975 = 1.959963984540054


# Numerators and denominators of the rational approximations to the normal quantile
# (Wichura 1988, algorithm AS 241), constant term first: near the median, in the tails, far out.
CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def normal_score(p: Column) -> Column:
    """Standard normal quantile at a probability per row; NULL outside (0, 1)."""
    q = p - 0.5
    near = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))

    def ratio(parts: tuple, x: Column) -> Column:
        return _polynomial(parts[0], x) / _polynomial(parts[1], x)

    out = F.when(r <= 5, ratio(TAIL, r - 1.6)).otherwise(ratio(FAR, r - 5))
    return F.when(
        (p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * ratio(CENTRE, near)).otherwise(F.signum(q) * out)
    )


def normal_quantile(p: Column | float, mean: Column, sd: Column) -> Column:
    """Quantile of a normal distribution with a mean and sd per row, at one probability or one per row."""
    score = normal_score(p) if isinstance(p, Column) else F.lit(NormalDist().inv_cdf(p))
    return mean + score * sd


def interval_sd(lcl: Column, ucl: Column, z: float = Z95) -> Column:
    """Standard deviation behind a symmetric interval of half width ``z`` sd."""
    return (ucl - lcl) / F.lit(2 * z)


def rescaled(estimate: Column, lcl: Column, ucl: Column, z_from: float, z_to: float):
    """Limits of the same normal distribution at another confidence level."""
    half = interval_sd(lcl, ucl, z_from) * F.lit(z_to)
    return estimate - half, estimate + half


def natural(x: Column, change: bool = False) -> Column:
    """From the log scale to a ratio, or to a relative change (ratio - 1)."""
    return F.exp(x) - 1 if change else F.exp(x)


def _number_text(x: Column, percent: bool, sign: bool, digits: int) -> Column:
    scaled = F.round(x * 100 if percent else x, digits)
    pattern = f"%{'+' if sign else ''}.{digits}f" + ("%%" if percent else "")
    return F.format_string(pattern, F.when(scaled == 0, 0.0).otherwise(scaled))


def interval_text(
    estimate: Column,
    lcl: Column,
    ucl: Column,
    link: str = "log",
    percent: bool = False,
    sign: bool = False,
    change: bool = False,
    digits: int = 1,
) -> Column:
    """Text ``estimate (lcl; ucl)`` with a fixed number of decimals."""

    def shown(x: Column) -> Column:
        value = natural(x, change) if link == "log" else x
        return _number_text(value, percent, sign, digits)

    return F.concat(
        shown(estimate), F.lit(" ("), shown(lcl), F.lit("; "), shown(ucl), F.lit(")")
    )
