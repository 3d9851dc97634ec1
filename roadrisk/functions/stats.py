"""Spatial-statistics formulas as Column expressions.

Gi* (Getis & Ord 1992; Ord & Getis 1995) with binary weights that include
the focal cell, the normal tail via Abramowitz & Stegun 7.1.26, and the
Mann-Kendall trend statistic (Mann 1945; Kendall 1975). Denominators are
guarded with NULLIF so ANSI mode returns NULL instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk import config as C
from roadrisk.functions import geo


def _nullif0(c: Column) -> Column:
    return F.when(c == geo.lit(0.0), F.lit(None).cast("double")).otherwise(c)


def gi_star_z(sum_x: Column, w: Column, n: Column, xbar: Column, s: Column) -> Column:
    """z = (sum_x - xbar*W) / (S * sqrt((n*W - W^2) / (n - 1)))."""
    sum_x = sum_x.cast("double")
    w = w.cast("double")
    n = n.cast("double")
    num = sum_x - xbar * w
    inner = (n * w - w * w) / _nullif0(n - geo.lit(1.0))
    den = s * F.sqrt(F.greatest(inner, geo.lit(0.0)))
    return num / _nullif0(den)


def global_mean(total: Column, n: Column) -> Column:
    return total.cast("double") / _nullif0(n.cast("double"))


def global_sd(sum_sq: Column, n: Column, xbar: Column) -> Column:
    """Population standard deviation from sums: sqrt(sum_sq/n - xbar^2)."""
    v = sum_sq.cast("double") / _nullif0(n.cast("double")) - xbar * xbar
    return F.sqrt(F.greatest(v, geo.lit(0.0)))


def two_sided_p(z: Column) -> Column:
    """p = 2 * (1 - Phi(|z|)) = erfc(|z| / sqrt 2), A&S 7.1.26 (|err| < 1.5e-7)."""
    x = F.abs(z) / geo.lit(2.0 ** 0.5)
    t = geo.lit(1.0) / (geo.lit(1.0) + geo.lit(C.AS_P) * x)
    a1, a2, a3, a4, a5 = C.AS_A
    poly = t * (geo.lit(a1) + t * (geo.lit(a2) + t * (geo.lit(a3) + t * (geo.lit(a4) + t * geo.lit(a5)))))
    return poly * F.exp(-(x * x))


def classify_z(z: Column) -> Column:
    return (
        F.when(z >= geo.lit(C.Z_99), F.lit("hot_99"))
        .when(z >= geo.lit(C.Z_95), F.lit("hot_95"))
        .when(z >= geo.lit(C.Z_90), F.lit("hot_90"))
        .when(z <= geo.lit(-C.Z_99), F.lit("cold_99"))
        .when(z <= geo.lit(-C.Z_95), F.lit("cold_95"))
        .when(z <= geo.lit(-C.Z_90), F.lit("cold_90"))
        .otherwise(F.lit("not_significant"))
    )


def mann_kendall_s(zs: Column) -> Column:
    """S = sum_{i<j} sign(z_j - z_i) over an array ordered by time.

    The array holds one value per time step, so its length is the number of
    steps (a parameter of the analysis, not of the data volume). One flat
    loop over the index pairs with O(1) ``element_at`` lookups; pass a column
    reference (not an expression) so the array is built once per row.
    """
    n = F.size(zs)
    zero = F.lit(0).cast("bigint")

    def add(acc, k):
        i = (k / n).cast("int") + 1
        j = k % n + 1
        d = F.signum(F.element_at(zs, j) - F.element_at(zs, i)).cast("bigint")
        return acc + F.when(i < j, F.coalesce(d, zero)).otherwise(zero)

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n * n - 1, F.lit(0))), zero, add)


def mann_kendall_s_fixed(zs: Column, t: int) -> Column:
    """The same S for arrays of exactly ``t`` values, unrolled into a plain
    sum of t(t-1)/2 sign terms: no lambda, so it stays in generated code.
    Use it when t is known and small; ``mann_kendall_s`` handles the rest."""
    zero = F.lit(0).cast("bigint")
    terms = [F.coalesce(F.signum(F.try_element_at(zs, F.lit(j)) - F.try_element_at(zs, F.lit(i))).cast("bigint"), zero)
             for i in range(1, t + 1) for j in range(i + 1, t + 1)]
    while len(terms) > 1:  # balanced sum: shallow expression tree
        terms = [terms[k] + terms[k + 1] if k + 1 < len(terms) else terms[k] for k in range(0, len(terms), 2)]
    return terms[0] if terms else zero


def mann_kendall_z(s: Column, t: Column) -> Column:
    """Continuity-corrected MK z with var = T(T-1)(2T+5)/18."""
    t = t.cast("double")
    var = t * (t - geo.lit(1.0)) * (geo.lit(2.0) * t + geo.lit(5.0)) / geo.lit(18.0)
    sd = F.sqrt(var)
    s = s.cast("double")
    return (
        F.when(s > geo.lit(0.0), (s - geo.lit(1.0)) / _nullif0(sd))
        .when(s < geo.lit(0.0), (s + geo.lit(1.0)) / _nullif0(sd))
        .otherwise(geo.lit(0.0))
    )
