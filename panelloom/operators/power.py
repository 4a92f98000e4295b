"""Yeo-Johnson power transform with maximum-likelihood exponent, in two scans.

1. A histogram of every column over the signed logarithm t = log(1 + |x|): per bin the number of
   values and the sums of the first powers of their distances from its middle. Histograms of parts add up, so
   this is a grouped aggregate. For x of one sign the transform is an exponential of t, whose sums
   over a bin follow from these powers, so the likelihood of any exponent is known on the driver.
2. One scan evaluates the likelihood itself around the exponents found, next to mean and deviation
   of the transformed columns. Where the step that it asks for is above ``TOLERANCE``, the step is
   taken and the scan repeated.
"""

import math

import numpy as np
from pyspark.sql import functions as F

from panelloom.session import stage

FINE_STEP, TOLERANCE = 2e-4, 1e-6
#: bins of a unit of t from 1 on, and of an octave of t below; the least octave; the powers that are kept
BINS, OCTAVES, POWERS = 16, 100, 6
#: exponents that are tried: 1 plus and minus multiples of a quarter, from 40 on in steps of a tenth
GRID = sorted({1.0 + sign * x for sign in (-1, 1) for x in [0.25 * k for k in range(160)] + [40 * 1.1 ** k for k in range(140)]})


def _signed_log(x):
    return F.signum(x) * F.log1p(F.abs(x))


def yeo_johnson(x, exponent):
    """The transform of one value; ``exponent`` is a column or a number."""
    lam = exponent if not isinstance(exponent, (int, float)) else F.lit(float(exponent))
    size = F.log1p(F.abs(x))
    power = F.when(x < 0, 2 - lam).otherwise(lam)
    grown = F.when(power == 0, size).otherwise(F.expm1(power * size) / power)
    return F.when(x < 0, -grown).otherwise(grown)


def _log_likelihoods(data, cols, candidates):
    """``{(column index, candidate index): (likelihood per row, mean, deviation)}`` for a few exponents per column.

    Each row is expanded to its (column, exponent) pairs inside the task and reduced by a
    partial aggregate, so one job serves all columns and only figures are shuffled.
    """
    width = len(next(iter(candidates.values())))
    # one array literal: the generated code does not change from round to round
    exponents = F.array(*[F.lit(float(lam)) for c in cols for lam in candidates[c]])
    cells = [F.struct(F.lit(i).alias("i"), F.col(c).alias("x")) for i, c in enumerate(cols)]
    long = (
        data.select(F.inline(F.array(*cells))).filter("x IS NOT NULL")
        .select("i", "x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("j"))
        .withColumn("lam", F.get(exponents, F.col("i") * width + F.col("j")))
    )
    shaped = yeo_johnson(F.col("x"), F.col("lam"))
    rows = long.groupBy("i", "j").agg(
        F.var_pop(shaped).alias("v"), F.avg(shaped).alias("m"), F.avg(_signed_log(F.col("x"))).alias("s")).collect()
    out = {}
    for row in rows:
        lam = candidates[cols[row["i"]]][row["j"]]
        likelihood = -0.5 * math.log(row["v"]) + (lam - 1) * row["s"] if row["v"] and row["v"] > 0 else None
        out[row["i"], row["j"]] = likelihood, row["m"], row["v"] and math.sqrt(row["v"])
    return out


def _narrow(df, cols):
    """The columns as doubles; a table that is not staged is read several times, so it is staged."""
    narrow = df.select([F.col(c).cast("double").alias(c) for c in cols])
    return narrow if getattr(df, "_panelloom_staged", False) else stage(narrow)


def _histograms(data, cols):
    """Per column the rows (negative?, middle, count, sums of powers, least, largest).

    t stays below 710 for any double, hence a column has at most ``2 * BINS * (710 + OCTAVES)`` bins.
    Below 1 they narrow with t: an exponent far from one matters where the product of both is large.
    """
    cells = [F.struct(F.lit(i).alias("i"), F.col(c).alias("x")) for i, c in enumerate(cols)]
    t = F.log1p(F.abs("x"))
    octave = F.greatest(F.coalesce(F.floor(F.log2(t) * BINS), F.lit(-BINS * OCTAVES)), F.lit(-BINS * OCTAVES))
    binned = data.select(F.inline(F.array(*cells))).filter("x IS NOT NULL").select(
        "i", (F.col("x") < 0).alias("neg"), F.when(t >= 1, F.floor(t * BINS)).otherwise(octave - BINS).alias("bin"), t.alias("t"), "x")
    place = F.col("bin") + 0.5
    binned = binned.withColumn("middle", F.when(F.col("bin") > 0, place / BINS).otherwise(F.pow(F.lit(2.0), (place + BINS) / BINS)))
    d = F.col("t") - F.col("middle")
    sums, power = [], F.lit(1.0)
    for k in range(POWERS + 1):
        sums.append(F.sum(power).alias(f"s{k}"))
        power = power * d
    rows = binned.groupBy("i", "neg", "bin", "middle").agg(F.min("x").alias("low"), F.max("x").alias("high"), *sums).collect()
    out = {c: [] for c in cols}
    for r in rows:
        out[cols[r["i"]]].append((r["neg"], r["middle"], *[r[f"s{k}"] for k in range(POWERS + 1)], r["low"], r["high"]))
    return {c: _Histogram(v) for c, v in out.items()}


class _Histogram:
    """Likelihood of an exponent from the bins of one column."""

    def __init__(self, rows):
        table = np.array(sorted(rows), float).reshape(-1, POWERS + 5)
        self.constant = not len(table) or table[:, -2].min() == table[:, -1].max()
        self.negative, self.n = table[:, 0] > 0, table[:, 2]
        raw = np.column_stack([np.ones(len(table)), table[:, 3:-2] / self.n[:, None]])  # means of d ** 0 .. d ** POWERS
        shift = raw[:, 1]
        # from the bin's middle to its mean, so that a narrow bin is as exact as its values are close
        self.middle = table[:, 1] + shift
        self.moments = np.column_stack([sum(math.comb(k, j) * raw[:, j] * (-shift) ** (k - j) for j in range(k + 1))
                                        for k in range(1, POWERS + 1)])
        self.total = self.n.sum()
        signed = np.where(self.negative, -1, 1) * self.middle
        self.mean_log = (self.n * signed).sum() / self.total if self.total else 0.0

    def likelihood(self, lam):
        """Per value, without constants; None where it is not defined."""
        power = np.where(self.negative, 2 - lam, lam)
        # within a bin y = y(middle) + e ** (power * middle) * u, u = (e ** (power * d) - 1) / power
        first, second, factor = 0.0, 0.0, 1.0
        for k in range(1, POWERS + 1):
            factor = factor * (power if k > 1 else 1.0) / k
            first = first + factor * self.moments[:, k - 1]
        for k in range(2, POWERS + 1):  # u ** 2 by the same series
            second = second + power ** (k - 2) * (2.0 ** k - 2) / math.factorial(k) * self.moments[:, k - 1]
        with np.errstate(over="ignore", invalid="ignore"):
            grown = np.where(power == 0, self.middle, np.expm1(power * self.middle) / np.where(power == 0, 1, power))
            slope = np.exp(power * self.middle)
            mean = np.where(self.negative, -1, 1) * (grown + slope * first)
            centre = (self.n * mean).sum() / self.total
            spread = slope ** 2 * (second - first ** 2)
            variance = (self.n * (spread + (mean - centre) ** 2)).sum() / self.total
        if not np.isfinite(variance) or variance <= 0:
            return None
        return -0.5 * math.log(variance) + (lam - 1) * self.mean_log

    def slope(self, lam, h=1e-3):
        """Derivative by five points, None where a point is not defined."""
        f = [self.likelihood(lam + k * h) for k in (-2, -1, 1, 2)]
        return None if None in f else (f[0] - 8 * f[1] + 8 * f[2] - f[3]) / (12 * h)

    def exponent(self):
        """Where the likelihood is largest; None for a column without spread."""
        if self.constant:
            return None
        known = [(f, -abs(lam - 1), at) for at, lam in enumerate(GRID) if (f := self.likelihood(lam)) is not None]
        if not known:
            return None
        at = max(known)[2]
        low, high = GRID[max(at - 1, 0)], GRID[min(at + 1, len(GRID) - 1)]
        for _ in range(60):
            middle = (low + high) / 2
            slope = self.slope(middle, 1e-3 * max(1.0, abs(middle)))
            if slope is None:
                break
            low, high = (middle, high) if slope > 0 else (low, middle)
        return (low + high) / 2


def fit_exponents(df, cols):
    """Exponent per column of largest likelihood; 1 for columns without spread.

    Two scans, unless a column's histogram leaves a step above ``TOLERANCE`` to be taken.
    """
    return {c: exponent for c, (exponent, _, _) in fit_yeo_johnson(df, cols).items()}


def _search(data, cols, rounds=12):
    """``{column: (exponent, mean, deviation)}``; mean and deviation are those at the exponent."""
    found = {c: h.exponent() for c, h in _histograms(data, cols).items()}
    at = {c: 1.0 if found[c] is None else found[c] for c in cols}
    out, open_cols = {}, list(cols)
    for number in range(rounds):
        steps = {c: FINE_STEP * max(1.0, abs(at[c])) for c in open_cols}
        exact = _log_likelihoods(data, open_cols, {c: [at[c] - steps[c], at[c], at[c] + steps[c]] for c in open_cols})
        left = []
        for i, c in enumerate(open_cols):
            (a, _, _), (b, mean, std), (d, _, _) = (exact.get((i, j), (None, None, None)) for j in range(3))
            out[c] = at[c], mean, std
            if found[c] is None or None in (a, b, d) or d - 2 * b + a >= 0:
                continue
            move = -(d - a) / 2 * steps[c] / (d - 2 * b + a)
            gain = (d - a) ** 2 / (8 * (2 * b - a - d))
            # a gain below rounding errors says nothing; far off, steps stay below four tenths
            if abs(move) > TOLERANCE * max(1.0, abs(at[c])) and gain > 1e-14 * max(1.0, abs(b)) and number < rounds - 1:
                at[c] += max(-2000 * steps[c], min(2000 * steps[c], move))
                left.append(c)
        open_cols = left
        if not open_cols:
            break
    return out


def fit_yeo_johnson(df, cols, exponents=None):
    """``{column: (exponent, mean, population std)}`` of the transformed column."""
    cols = list(cols)
    data = _narrow(df, cols)
    if exponents is None:
        return _search(data, cols)
    shaped = {c: yeo_johnson(F.col(c), exponents[c]) for c in cols}
    row = data.agg(*[x for c in cols for x in (
        F.avg(shaped[c]).alias(f"{c}|mean"), F.stddev_pop(shaped[c]).alias(f"{c}|std"))]).first()
    return {c: (exponents[c], row[f"{c}|mean"], row[f"{c}|std"]) for c in cols}


def transform_yeo_johnson(df, cols, exponents=None, source=None):
    """Standardised ``<name>_Yeo`` in place of each column.

    ``source`` is a staged table holding the columns to fit on; by default ``df`` itself.
    """
    fitted = fit_yeo_johnson(df if source is None else source, cols, exponents)

    def scaled(c):
        exponent, mean, std = fitted[c]
        value = yeo_johnson(F.col(c).cast("double"), exponent)
        return ((value - F.lit(mean)) / (std if std else 1.0)).alias(f"{c}_Yeo")

    return df.select(*[c for c in df.columns if c not in cols], *[scaled(c) for c in cols])
