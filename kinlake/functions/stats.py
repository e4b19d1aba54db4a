"""Exact tests as column expressions: sums over log factorials, no user functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF_LOG_2PI = 0.9189385332046727
#: Coefficients of Lanczos' approximation of the gamma function (g = 7; fixed values).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
#: Outcomes whose probability is within this factor of the observed one count as ties.
TIE = 1 + 1e-7


def log_factorial(n: Column) -> Column:
    """Natural log of n! for n >= 0, good to about 13 digits; any n, no table."""
    x = n.cast("double")
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (x + i)
    t = x + 7.5
    return F.lit(_HALF_LOG_2PI) + (x + 0.5) * F.log(t) - t + F.log(series)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def binomial_two_sided(k: Column, n: Column) -> Column:
    """p of k successes in n fair trials, by the probabilities not above the observed one; 1 for n = 0."""
    tail = _sum(F.transform(F.sequence(F.lit(0), F.least(k, n - k)), lambda i: F.exp(log_choose(n, i) - n * F.log(F.lit(2.0)))))
    return F.when(n == 0, 1.0).when(2 * k == n, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail))


def binomial_below(k: Column, n: Column, limit: float) -> Column:
    """Whether binomial_two_sided is under a small limit. A lower bound of the tail settles nearly all cases in closed form, and the sum is
    left for the extreme ones."""
    low = F.least(k, n - k).cast("double")
    share = low / n
    entropy = lambda p: F.when(p > 0, p * F.log(2 * p)).otherwise(F.lit(0.0))
    apart = n * (entropy(share) + entropy(1 - share))
    # P(X <= k) >= exp(-n D) / sqrt(8 n a (1 - a)) for 0 < a = k / n <= 1/2, and 2 ** -n for k = 0
    bound = F.when(low == 0, 2 * F.exp(-n * F.log(F.lit(2.0)))).otherwise(2 * F.exp(-apart) / F.sqrt(8 * n * share * (1 - share)))
    return F.when((n <= 0) | (bound >= limit), False).otherwise(binomial_two_sided(k, n) < limit)


def hypergeometric(k: Column, white: Column, black: Column, drawn: Column) -> Column:
    """Probability of k white among `drawn` from white + black."""
    return F.exp(log_choose(white, k) + log_choose(black, drawn - k) - log_choose(white + black, drawn))


def hypergeometric_tail(k: Column, white: Column, black: Column, drawn: Column) -> Column:
    """Probability of k white or more."""
    top = F.least(white, drawn)
    low = F.greatest(k, drawn - black, F.lit(0).cast("long"))
    return F.when(low > top, 0.0).otherwise(F.least(F.lit(1.0), _sum(F.transform(F.sequence(low, top), lambda i: hypergeometric(i, white, black, drawn)))))


def fisher_two_sided(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Fisher's exact test of the table [[a, b], [c, d]], by the probabilities not above the observed one."""
    seen = hypergeometric(a, a + b, c + d, a + c)
    low, high = F.greatest(F.lit(0).cast("long"), a - d), F.least(a + b, a + c)
    every = F.transform(F.sequence(low, high), lambda i: hypergeometric(i, a + b, c + d, a + c))
    return F.least(F.lit(1.0), F.aggregate(every, F.lit(0.0), lambda s, p: s + F.when(p <= seen * TIE, p).otherwise(0.0)))


def hardy_weinberg(hom_ref: Column, het: Column, hom_var: Column) -> Column:
    """Exact Hardy-Weinberg test with the mid-p correction; 1 where an allele is missing altogether.

    Outcomes are weighed against the observed one, up and down from it, each from the one before by a ratio of whole numbers, so that no term
    needs a logarithm. Where the sum overflows, p is 0."""
    r, h, v = (c.cast("double") for c in (hom_ref, het, hom_var))
    rare = F.least(2 * hom_ref + het, 2 * hom_var + het)
    steps = lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("long"), n.cast("long"))).when(n.isNotNull(), F.array().cast("array<long>"))

    def add(ratio):
        def one(a: Column, j: Column) -> Column:
            w = a["w"] * ratio(j)
            return F.struct(w.alias("w"), (a["all"] + w).alias("all"), (a["below"] + F.when(w * TIE < 1, w).when(w <= TIE, w / 2).otherwise(0.0)).alias("below"))

        return one

    up = add(lambda j: 4 * (r - j + 1) * (v - j + 1) / ((h + 2 * j - 1) * (h + 2 * j)))
    down = add(lambda j: (h - 2 * j + 2) * (h - 2 * j + 1) / (4 * (r + j) * (v + j)))
    start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("all"), F.lit(0.5).alias("below"))
    # the walk down begins anew at the observed outcome, with the sums of the walk up
    half = F.aggregate(steps(F.least(hom_ref, hom_var)), start, up, lambda a: F.struct(F.lit(1.0).alias("w"), a["all"].alias("all"), a["below"].alias("below")))
    p = F.aggregate(steps(F.floor(het / 2)), half, down, lambda a: a["below"] / a["all"])
    return F.when(rare == 0, 1.0).otherwise(p)


def erfc(x: Column) -> Column:
    """Complementary error function, relative error under 1.2e-7 (Chebyshev fit with fixed coefficients)."""
    z = F.abs(x)
    t = 1 / (1 + 0.5 * z)
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    value = t * F.exp(-z * z + poly)
    return F.when(x >= 0, value).otherwise(2 - value)


def normal_upper(z: Column) -> Column:
    return erfc(z / F.sqrt(F.lit(2.0))) / 2


def chi2_upper_1df(x: Column) -> Column:
    return erfc(F.sqrt(x / 2))


def chi2_upper_even(x: Column, half_df: int) -> Column:
    """Upper tail for 2 * half_df degrees of freedom, in closed form."""
    term, total = F.lit(1.0), F.lit(1.0)
    for i in range(1, half_df):
        term = term * (x / 2) / i
        total = total + term
    return F.exp(-x / 2) * total


def chi2_upper_even_of(x: Column, half_df: Column) -> Column:
    """Upper tail for 2 * half_df degrees of freedom, half_df by row; terms in logs, so that none overflows."""
    each = F.transform(F.sequence(F.lit(0).cast("long"), half_df.cast("long") - 1), lambda i: F.exp(i * F.log(x / 2) - log_factorial(i) - x / 2))
    return F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), _sum(each)))


def _t_upper_5(df: Column) -> Column:
    """The value that Student's t exceeds with probability 0.05, df >= 2; from 5 on by Cornish and Fisher's expansion (error under 1e-4)."""
    z = 1.6448536269514722
    g = ((z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384, (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
    series = F.lit(z)
    for i, c in enumerate(g, 1):
        series = series + F.lit(c) / F.pow(df, F.lit(float(i)))
    return F.when(df == 2, 2.919986).when(df == 3, 2.353363).when(df == 4, 2.131847).otherwise(series)


def t_test_power(n1: Column, n2: Column, effect: Column, steps: int = 400) -> Column:
    """Power of the one-sided two-sample t test at level 0.05: the upper tail of the noncentral t law, as a sum over the law of the
    standard deviation. Null unless both samples have two members."""
    df = (n1 + n2 - 2).cast("double")
    shift = effect * F.sqrt(n1 * n2 / (n1 + n2))
    half = 8 / F.sqrt(2 * df)
    low = F.greatest(F.lit(0.0), 1 - half)
    width = (1 + half - low) / steps
    cut = _t_upper_5(df)

    def add(a: Column, i: Column) -> Column:
        s = low + width * (i + 0.5)
        w = F.exp((df - 1) * F.log(s) - df * (s * s - 1) / 2)
        return F.struct((a["w"] + w).alias("w"), (a["p"] + w * normal_upper(cut * s - shift)).alias("p"))

    power = F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("p")), add, lambda a: a["p"] / a["w"])
    return F.when((n1 > 1) & (n2 > 1), power)
