"""Sigma levels of a yield (the share of opportunities without a defect), and their grades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The usual power approximation of the normal quantile, and the long-term shift of 1.5.
APPROX_SCALE = 5.5556
APPROX_EXPONENT = 0.1186
SHIFT = 1.5

# Coefficients of algorithm AS 241 (Wichura 1988, PPND16), lowest power first.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)

# Lower bounds of the sigma grades, best first.
SIGMA_GRADES = ((6.0, "World-class"), (5.0, "Excellent"), (4.0, "Good"), (3.0, "Acceptable"))
LOWEST_GRADE = "Needs Attention"


def sigma_approx(process_yield: Column) -> Column:
    return F.lit(APPROX_SCALE) * (F.lit(1.0) - F.pow(F.lit(1.0) - process_yield, F.lit(APPROX_EXPONENT))) + F.lit(SHIFT)


def _rational(x: Column, coefficients: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    numerator, denominator = (reduce(lambda acc, c: acc * x + F.lit(c), reversed(c[:-1]), F.lit(c[-1])) for c in coefficients)
    return numerator / denominator


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution; NULL outside (0, 1)."""
    q = p - F.lit(0.5)
    central = q * _rational(F.lit(0.180625) - q * q, CENTRAL)
    r = F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    outer = F.when(r <= 5.0, _rational(r - F.lit(1.6), MIDDLE)).otherwise(_rational(r - F.lit(5.0), TAIL))
    signed = F.when(q < 0, -outer).otherwise(outer)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, central).otherwise(signed))


def sigma_exact(process_yield: Column) -> Column:
    """Normal quantile of the yield plus the shift; NULL for a yield of 0, 1 or NULL."""
    return normal_quantile(process_yield) + F.lit(SHIFT)


def sigma_grade(sigma: Column) -> Column:
    graded = reduce(lambda acc, band: acc.when(sigma >= band[0], band[1]), SIGMA_GRADES[1:],
                    F.when(sigma >= SIGMA_GRADES[0][0], SIGMA_GRADES[0][1]))
    return graded.otherwise(LOWEST_GRADE)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``sigma_level(yield)`` available to SQL users of this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sigma_level(process_yield DOUBLE) RETURNS DOUBLE "
        f"RETURN {APPROX_SCALE} * (1 - power(1 - process_yield, {APPROX_EXPONENT})) + {SHIFT}"
    )
