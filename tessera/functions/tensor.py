"""Native (Catalyst) tensor expressions over a flat H-W-C ``array<double>``.

An image is four columns: ``height``, ``width``, ``channels`` and ``data``
(row-major H-W-C).  Everything here is a built-in higher-order function, so
it runs inside the JVM with no Python crossing.

One trap shapes this module: a per-row statistic referenced inside a lambda
(``transform(d, x -> x - array_min(d))``) is re-evaluated for every element
once the optimizer collapses the projections, which makes the operator
quadratic in the image size.  The same happens to the input array itself
when it is an expression (not a column) read inside an index lambda
(``transform(sequence(..), i -> d[f(i)])``).  :func:`let` binds a value
once per row (``transform(array(v), b -> body(b))[0]``); every function
below binds its input array and its statistics through it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def to_double_array(arr) -> Column:
    return F.transform(_col(arr), lambda x: x.cast("double"))


def to_float_array(arr) -> Column:
    return F.transform(_col(arr), lambda x: x.cast("float"))


def array_sum(d) -> Column:
    return F.aggregate(_col(d), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def array_mean(d) -> Column:
    d = _col(d)
    return array_sum(d) / F.size(d)


def array_std_pop(d) -> Column:
    """Population standard deviation, two-pass (array and mean bound once)."""
    return let(
        _col(d),
        lambda d: let(
            array_mean(d),
            lambda m: F.sqrt(F.aggregate(d, F.lit(0.0).cast("double"), lambda acc, x: acc + (x - m) * (x - m)) / F.size(d)),
        ),
    )


def tensor_stats(d) -> Column:
    """struct(min, max, mean, std) of one tensor, each statistic bound once."""
    return let(_col(d), _tensor_stats)


def _tensor_stats(d: Column) -> Column:
    return let(
        F.struct(
            F.array_min(d).alias("t_min"),
            F.array_max(d).alias("t_max"),
            array_mean(d).alias("t_mean"),
        ),
        lambda s: F.struct(
            s["t_min"].alias("t_min"),
            s["t_max"].alias("t_max"),
            s["t_mean"].alias("t_mean"),
            F.sqrt(
                F.aggregate(d, F.lit(0.0).cast("double"), lambda acc, x: acc + (x - s["t_mean"]) * (x - s["t_mean"]))
                / F.size(d)
            ).alias("t_std"),
        ),
    )


def partial_sums(d) -> Column:
    """Per-image partial aggregates (n, sum, sum of squares, min, max), the
    map side of dataset statistics: pixels are never exploded or shuffled."""
    d = _col(d)
    zero = F.lit(0.0).cast("double")
    return F.struct(
        F.size(d).cast("bigint").alias("n"),
        F.aggregate(d, zero, lambda acc, x: acc + x).alias("s1"),
        F.aggregate(d, zero, lambda acc, x: acc + x * x).alias("s2"),
        F.array_min(d).alias("mn"),
        F.array_max(d).alias("mx"),
    )


# -- normalisation -----------------------------------------------------------


def normalize_min_max(d, lo: float = 0.0, hi: float = 1.0) -> Column:
    """(x - min) / (max - min + 1e-8) * (hi - lo) + lo over the whole tensor."""
    return let(_col(d), lambda dd: _min_max(dd, lo, hi))


def _min_max(d: Column, lo: float, hi: float) -> Column:
    return let(
        F.struct(F.array_min(d).alias("mn"), F.array_max(d).alias("mx")),
        lambda s: F.transform(
            d, lambda x: (x - s["mn"]) / (s["mx"] - s["mn"] + F.lit(EPS)) * F.lit(float(hi - lo)) + F.lit(float(lo))
        ),
    )


def normalize_z_score(d) -> Column:
    """(x - mean) / (population std + 1e-8) over the whole tensor."""
    return let(
        _col(d),
        lambda dd: let(_tensor_stats(dd), lambda s: F.transform(dd, lambda x: (x - s["t_mean"]) / (s["t_std"] + F.lit(EPS)))),
    )


def normalize(d, method: str, lo: float = 0.0, hi: float = 1.0) -> Column:
    if method == "min_max":
        return normalize_min_max(d, lo, hi)
    if method == "z_score":
        return normalize_z_score(d)
    # any other method (including "none"): float values unchanged
    return to_double_array(d)


# -- geometry ----------------------------------------------------------------


def hflip(d, h, w, c) -> Column:
    """T[y, w-1-x, c]."""
    h, w, c = _col(h), _col(w), _col(c)
    row = w * c
    return let(
        _col(d),
        lambda d: F.transform(
            F.sequence(F.lit(0), F.size(d) - 1),
            lambda i: d[F.floor(i / row).cast("int") * row + (w - 1 - F.floor(i / c).cast("int") % w) * c + i % c],
        ),
    )


def vflip(d, h, w, c) -> Column:
    """T[h-1-y, x, c]."""
    h, w, c = _col(h), _col(w), _col(c)
    row = w * c
    return let(
        _col(d),
        lambda d: F.transform(
            F.sequence(F.lit(0), F.size(d) - 1),
            lambda i: d[(h - 1 - F.floor(i / row).cast("int")) * row + i % row],
        ),
    )


def nest(d, h, w, c) -> Column:
    """Flat H-W-C to [H][W][C] (only at export; it duplicates the data)."""
    h, w, c = _col(h), _col(w), _col(c)
    return let(
        _col(d),
        lambda d: F.transform(
            F.sequence(F.lit(0), h - 1),
            lambda y: F.transform(F.sequence(F.lit(0), w - 1), lambda x: F.slice(d, (y * w + x) * c + 1, c)),
        ),
    )


def unnest(nested) -> Column:
    """[H][W][C] back to the flat row-major form."""
    return F.flatten(F.flatten(_col(nested)))


def shape(h, w, c) -> Column:
    return F.array(_col(h).cast("int"), _col(w).cast("int"), _col(c).cast("int"))


# -- colour --------------------------------------------------------------------


def to_rgb(d, h, w, c, bgr: bool = True) -> Column:
    """1 channel replicated x3; 3/4 channels (B,G,R[,A] as the image source
    stores them) reordered to R,G,B with alpha dropped."""
    c = _col(c)
    n_out = _col(h) * _col(w) * 3
    if bgr:
        src = lambda i: F.floor(i / 3).cast("int") * c + (2 - i % 3)
    else:
        src = lambda i: F.floor(i / 3).cast("int") * c + i % 3
    return let(
        _col(d),
        lambda d: F.transform(
            F.sequence(F.lit(0), n_out - 1),
            lambda i: F.when(c == 1, d[F.floor(i / 3).cast("int")]).otherwise(d[src(i)]),
        ),
    )


def rgb_to_gray(d, h, w, round_u8: bool = True) -> Column:
    """0.299 R + 0.587 G + 0.114 B; rounded to an integer level for u8 input."""
    n = _col(h) * _col(w)

    def px(d, p):
        v = F.lit(0.299) * d[p * 3] + F.lit(0.587) * d[p * 3 + 1] + F.lit(0.114) * d[p * 3 + 2]
        return F.floor(v + F.lit(0.5)).cast("double") if round_u8 else v

    return let(_col(d), lambda d: F.transform(F.sequence(F.lit(0), n - 1), lambda p: px(d, p)))


def to_u8(d) -> Column:
    """Clip to [0, 255] and truncate, the uint8 cast of the original."""
    return F.transform(_col(d), lambda x: F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(255.0))).cast("double"))


def brightness(d, factor, lo: float = 0.0, hi: float = 1.0, mode: str = "clip_range") -> Column:
    """Scale by ``factor``.  Default: clip to the normalised range [lo, hi]
    and stay float.  ``u8_compat``: clip to [0, 255] and truncate to an
    integer level, as the original does after normalisation."""
    d, f = _col(d), _col(factor)
    if mode == "u8_compat":
        return F.transform(d, lambda x: F.floor(F.least(F.greatest(x * f, F.lit(0.0)), F.lit(255.0))).cast("double"))
    return F.transform(d, lambda x: F.least(F.greatest(x * f, F.lit(float(lo))), F.lit(float(hi))))


def round6(x) -> Column:
    """Round to 6 decimals and fold -0.0 into 0.0 (comparison form)."""
    return F.round(_col(x), 6) + F.lit(0.0)
