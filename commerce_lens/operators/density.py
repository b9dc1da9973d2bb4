"""Gaussian kernel densities and pair grids.

Fast Gauss transform: with the kernel scaled to a unit circle, rows are summed up per small box, in one aggregate
that merges in the map stage, and each box visits the grid cells within REACH bandwidths once, beyond which its kernel
is below the precision of a double. A box keeps moments of total degree below ORDER, the Taylor
expansion of its rows' kernels around its centre in Hermite polynomials: by Cramer's inequality the rest of the expansion is
below 1e-9 of the kernel's peak for boxes of side BOX. A box whose rows are one point is expanded around that point, without error.

So what is shuffled and what visits cells is bounded by boxes and cells, not by distinct points; both grow with
the inverse of the bandwidth, n^(1/5) or n^(1/3), only. Where some FEW distinct points make up all rows, each is a
box of its own, of which the count alone matters. Cells that no box visits have density 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lens.operators.select import dropna_subset
from commerce_lens.operators.stats import long_values
from commerce_lens.session import cut_lineage

# In bandwidths: how far a box's centre reaches, and a box's side.
REACH = 9.2
BOX = 0.4
ORDER = 11
# Distinct points of a column or pair, by estimate, that are boxes of their own.
FEW = 100_000


def _powers(prefix: str, c: str) -> dict[str, Column]:
    """c^k / k! for k below ORDER, each named by prefix and k."""
    out, term = {}, F.lit(1.0)
    for k in range(ORDER):
        out[f"{prefix}{k}"] = term
        term = term * F.col(c) / F.lit(float(k + 1))
    return out


def _hermite(prefix: str, c: str, order: int) -> dict[str, Column]:
    """The probabilists' Hermite polynomials of c below an order, by Horner's rule, each named by prefix and degree."""
    out, square = {}, F.col(c) * F.col(c)
    for k in range(order):
        value = F.lit(0.0)
        for m in range(k // 2 + 1):
            factor = (-1) ** m * math.factorial(k) // (math.factorial(m) * math.factorial(k - 2 * m) * 2**m)
            value = (value * square if m else value) + F.lit(float(factor))
        out[f"{prefix}{k}"] = value * F.col(c) if k % 2 else value
    return out


def _order(spread: DataFrame) -> int:
    """Below which degree moments are kept: 1, the counts, where all distinct points are boxes, else ORDER."""
    most = spread.agg(F.max("distinct")).first()[0]
    return 1 if most is not None and most <= FEW else ORDER


def _box(u: Column) -> Column:
    return F.floor(u / BOX)


def _middle(b: str) -> Column:
    return (F.col(b) + 0.5) * BOX


def _cells(lo: Column, hi: Column, centre: Column, half: Column, size: int) -> Column:
    """The numbers of the grid cells within `half` of a centre; an empty list if there are none."""
    step = (hi - lo) / F.lit(float(size - 1))
    first = F.greatest(F.lit(0), F.ceil((centre - half - lo) / step)).cast("int")
    last = F.least(F.lit(size - 1), F.floor((centre + half - lo) / step)).cast("int")
    return F.when(first <= last, F.sequence(first, F.greatest(first, last)))


def _grid(lo: Column, hi: Column, i: Column, size: int) -> Column:
    return lo + i * ((hi - lo) / F.lit(float(size - 1)))


def line_boxes(values: DataFrame, spread: DataFrame) -> DataFrame:
    """(column, centre, m): the boxes of each column with their moments."""
    known = F.broadcast(spread.select("column", "lo", "h"))
    placed = values.join(known, "column").withColumn("u", (F.col("value") - F.col("lo")) / F.col("h"))
    placed = placed.withColumn("bu", _box(F.col("u"))).withColumn("d", F.col("u") - _middle("bu")).withColumns(_powers("p", "d"))
    ends = [F.min("value").alias("least"), F.max("value").alias("most")]
    boxes = placed.groupBy("column", "bu").agg(*ends, *[F.sum(f"p{k}").alias(f"m{k}") for k in range(ORDER)])
    single = F.col("least") == F.col("most")
    return boxes.join(known, "column").select(
        "column",
        F.when(single, F.col("least")).otherwise(F.col("lo") + _middle("bu") * F.col("h")).alias("centre"),
        *[(F.when(single, F.lit(0.0)).otherwise(F.col(f"m{k}")) if k else F.col("m0")).alias(f"m{k}") for k in range(ORDER)],
    )


def kde_1d(
    df: DataFrame, columns: str | Sequence[str], grid: int = 200, bw_adjust: float = 1.0, cut: float = 0.0
) -> DataFrame:
    """Density of each column on an even grid: (column, i, x, density).

    Bandwidth n^(-1/5) * sample deviation * bw_adjust. The grid spans the data and `cut`
    bandwidths to both sides. A column without spread has no density and no rows.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    values = long_values(df, columns)
    spread = values.groupBy("column").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.approx_count_distinct("value").alias("distinct"),
    )
    spread = spread.where(F.col("sd") > 0).withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2)) * bw_adjust)
    spread = spread.select("column", "n", "h", "distinct", (F.col("lo") - cut * F.col("h")).alias("lo"), (F.col("hi") + cut * F.col("h")).alias("hi"))
    # The spread has one row per column; written, it is not computed anew from all rows for each use.
    spread = cut_lineage(spread, "spread")
    order = _order(spread)
    if order == 1:
        boxes = values.groupBy("column", F.col("value").alias("centre")).agg(F.count(F.lit(1)).cast("double").alias("m0"))
    else:
        boxes = line_boxes(values, spread)
    at = boxes.join(F.broadcast(spread), "column")
    at = at.withColumn("i", F.explode(_cells(F.col("lo"), F.col("hi"), F.col("centre"), REACH * F.col("h"), grid)))
    x = _grid(F.col("lo"), F.col("hi"), F.col("i"), grid)
    at = at.withColumn("z", (x - F.col("centre")) / F.col("h")).withColumns(_hermite("g", "z", order))
    k = sum((F.col(f"m{k}") * F.col(f"g{k}") for k in range(1, order)), F.col("m0")) * F.exp(-0.5 * F.col("z") * F.col("z"))
    sums = at.select("column", "i", k.alias("k")).groupBy("column", "i").agg(F.sum("k").alias("k"))
    frame = spread.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    scale = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return frame.join(sums, ["column", "i"], "left").select("column", "i", x.alias("x"), (F.coalesce("k", F.lit(0.0)) / scale).alias("density"))


def _pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(x_column, y_column, px, py) of the rows that have both values, from one read of df."""
    panels = ", ".join(
        f"""struct('{x}' AS x_column, '{y}' AS y_column,
                   CAST(`{x}` AS DOUBLE) AS px, CAST(`{y}` AS DOUBLE) AS py)"""
        for x, y in pairs
    )
    return df.selectExpr(f"inline(array({panels}))").where("px IS NOT NULL AND py IS NOT NULL")


def _across(points: DataFrame, spread: DataFrame, grid: int) -> DataFrame:
    """The points with the columns i of grid cells that they visit. The spread has one row per pair of columns."""
    reach = _cells(F.col("lox"), F.col("hix"), F.col("px"), REACH * F.sqrt("vx"), grid)
    return points.join(F.broadcast(spread), ["x_column", "y_column"]).withColumn("i", F.explode(reach))


def _along(columns: DataFrame, grid: int) -> DataFrame:
    """Points and columns i with the cells j in them: within REACH, y keeps to a band around its mean for x."""
    dx = _grid(F.col("lox"), F.col("hix"), F.col("i"), grid) - F.col("px")
    middle, half = F.col("py") + F.col("vxy") / F.col("vx") * dx, REACH * F.sqrt(F.col("det") / F.col("vx"))
    return columns.withColumn("j", F.explode(_cells(F.col("loy"), F.col("hiy"), middle, half, grid)))


def pair_visits(points: DataFrame, spread: DataFrame, grid: int) -> DataFrame:
    """The points with the grid cells (i, j) that they visit."""
    return _along(_across(points, spread, grid), grid)


def pair_boxes(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """(x_column, y_column, px, py, m_a_b): the boxes of each pair of columns, their centres and their moments.
    x is measured in its bandwidth, and y, less its mean for x, in the bandwidth that is left, so that the kernel is round.
    """
    slope, left = F.col("vxy") / F.col("vx"), F.sqrt(F.col("det") / F.col("vx"))
    known = F.broadcast(spread.select("x_column", "y_column", "lox", "loy", "vx", "vxy", "det"))
    right = F.col("px") - F.col("lox")
    placed = rows.join(known, ["x_column", "y_column"]).withColumns(
        {"u": right / F.sqrt("vx"), "v": (F.col("py") - F.col("loy") - slope * right) / left}
    )
    placed = placed.withColumns({"bu": _box(F.col("u")), "bv": _box(F.col("v"))})
    placed = placed.withColumns({"du": F.col("u") - _middle("bu"), "dv": F.col("v") - _middle("bv")})
    placed = placed.withColumns(_powers("p", "du") | _powers("q", "dv"))
    degrees = [(a, b) for a in range(ORDER) for b in range(ORDER - a)]
    ends = [f(c).alias(f"{n}_{c}") for c in ("px", "py") for n, f in (("least", F.min), ("most", F.max))]
    boxes = placed.groupBy("x_column", "y_column", "bu", "bv").agg(
        *ends, *[F.sum(F.col(f"p{a}") * F.col(f"q{b}")).alias(f"m_{a}_{b}") for a, b in degrees]
    )
    single = (F.col("least_px") == F.col("most_px")) & (F.col("least_py") == F.col("most_py"))
    px = F.col("lox") + _middle("bu") * F.sqrt("vx")
    py = F.col("loy") + slope * _middle("bu") * F.sqrt("vx") + _middle("bv") * left
    return boxes.join(known, ["x_column", "y_column"]).select(
        "x_column",
        "y_column",
        F.when(single, F.col("least_px")).otherwise(px).alias("px"),
        F.when(single, F.col("least_py")).otherwise(py).alias("py"),
        *[(F.when(single, F.lit(0.0)).otherwise(F.col(f"m_{a}_{b}")) if a + b else F.col("m_0_0")).alias(f"m_{a}_{b}") for a, b in degrees],
    )


def pair_spread(rows: DataFrame, bw_adjust: float, cut: float) -> DataFrame:
    """Count, kernel covariance and grid bounds of each pair of columns; none for a singular covariance."""
    spread = rows.groupBy("x_column", "y_column").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.var_samp("px").alias("vx"),
        F.var_samp("py").alias("vy"),
        F.covar_samp("px", "py").alias("vxy"),
        F.approx_count_distinct(F.struct("px", "py")).alias("distinct"),
        *[f(c).alias(f"{n}{c[-1]}") for c in ("px", "py") for n, f in (("lo", F.min), ("hi", F.max))],
    )
    factor = F.pow("n", F.lit(-1 / 6)) * bw_adjust
    spread = spread.withColumns({c: F.col(c) * factor * factor for c in ("vx", "vy", "vxy")}).withColumn(
        "det", F.col("vx") * F.col("vy") - F.col("vxy") * F.col("vxy")
    )
    # Rounding leaves a determinant near zero for columns that determine each other.
    spread = spread.where(F.col("det") > 1e-12 * F.col("vx") * F.col("vy"))
    edges = [
        e.alias(name)
        for c in ("x", "y")
        for name, e in (
            (f"lo{c}", F.col(f"lo{c}") - cut * F.sqrt(f"v{c}")),
            (f"hi{c}", F.col(f"hi{c}") + cut * F.sqrt(f"v{c}")),
        )
    ]
    return spread.select("x_column", "y_column", "n", "distinct", "vx", "vy", "vxy", "det", *edges)


def kde_2d(
    df: DataFrame, pairs: Sequence[tuple[str, str]], grid: int = 200, bw_adjust: float = 0.5, cut: float = 3.0
) -> DataFrame:
    """Density of (x, y) column pairs on an even grid: (x_column, y_column, i, j, x, y, density).

    The kernel has the full sample covariance, scaled by n^(-1/6) * bw_adjust on each axis.
    A pair whose covariance is singular has no density and no rows.
    """
    rows = _pair_rows(df, pairs)
    spread = cut_lineage(pair_spread(rows, bw_adjust, cut), "spread")
    order = _order(spread)
    if order == 1:
        boxes = rows.groupBy("x_column", "y_column", "px", "py").agg(F.count(F.lit(1)).cast("double").alias("m_0_0"))
    else:
        boxes = pair_boxes(rows, spread)
    at = _across(boxes, spread, grid)
    dx = _grid(F.col("lox"), F.col("hix"), F.col("i"), grid) - F.col("px")
    at = at.withColumn("z", dx / F.sqrt("vx")).withColumns(_hermite("g", "z", order))
    # Moments in x are summed up once a column of cells, those in y once a cell.
    kernel = F.exp(-0.5 * F.col("z") * F.col("z"))
    inner = {f"c{b}": kernel * sum((F.col(f"m_{a}_{b}") * F.col(f"g{a}") for a in range(1, order - b)), F.col(f"m_0_{b}")) for b in range(order)}
    bounds = ["x_column", "y_column", "px", "py", "lox", "hix", "loy", "hiy", "vx", "vxy", "det", "i"]
    at = _along(at.select(*bounds, *[c.alias(n) for n, c in inner.items()]), grid)
    dy = _grid(F.col("loy"), F.col("hiy"), F.col("j"), grid) - F.col("py")
    at = at.withColumn("z", (dy - F.col("vxy") / F.col("vx") * dx) / F.sqrt(F.col("det") / F.col("vx"))).withColumns(_hermite("g", "z", order))
    k = F.exp(-0.5 * F.col("z") * F.col("z")) * sum((F.col(f"c{b}") * F.col(f"g{b}") for b in range(1, order)), F.col("c0"))
    sums = at.select("x_column", "y_column", "i", "j", k.alias("k")).groupBy("x_column", "y_column", "i", "j").agg(F.sum("k").alias("k"))
    steps = F.sequence(F.lit(0), F.lit(grid - 1))
    frame = spread.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))
    return frame.join(sums, ["x_column", "y_column", "i", "j"], "left").select(
        "x_column",
        "y_column",
        "i",
        "j",
        _grid(F.col("lox"), F.col("hix"), F.col("i"), grid).alias("x"),
        _grid(F.col("loy"), F.col("hiy"), F.col("j"), grid).alias("y"),
        (F.coalesce("k", F.lit(0.0)) / (F.col("n") * 2 * math.pi * F.sqrt("det"))).alias("density"),
    )


def kde_levels(density: DataFrame, levels: int = 40, lowest: float = 0.05) -> DataFrame:
    """Contour levels of kde_2d: (x_column, y_column, level, proportion, density).

    Proportions run evenly from `lowest` to 1; the contour at a proportion leaves that share
    of the mass outside. The window runs over the grid of one pair, a fixed number of rows.
    """
    keys = ["x_column", "y_column"]
    descending = Window.partitionBy(*keys).orderBy(F.desc("density"), "i", "j")
    mass = F.sum("density").over(descending) / F.sum("density").over(Window.partitionBy(*keys))
    ranked = density.withColumn("_mass", mass)
    step = (1 - lowest) / (levels - 1)
    wanted = ranked.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    proportion = F.when(F.col("level") == levels - 1, F.lit(1.0)).otherwise(F.lit(lowest) + F.col("level") * F.lit(step))
    return (
        wanted.withColumn("proportion", proportion)
        .groupBy(*keys, "level", "proportion")
        .agg(
            F.coalesce(
                F.max(F.when(F.col("_mass") >= 1 - F.col("proportion"), F.col("density"))), F.min("density")
            ).alias("density")
        )
    )


def pair_grid(df: DataFrame, columns: Sequence[str], kind: str = "scatter", grid: int = 200) -> DataFrame:
    """Panels of a lower-triangle pair grid over rows without NULLs, in long form.

    (y_column, x_column, panel, x, y, value): a density curve per diagonal panel (y NULL),
    and off the diagonal either the distinct points with their frequency ("scatter") or the
    bivariate density ("kde").
    """
    columns = list(columns)
    rows = dropna_subset(df.select(*columns), columns)
    diagonal = kde_1d(rows, columns, grid, cut=3.0).select(
        F.col("column").alias("y_column"),
        F.col("column").alias("x_column"),
        F.lit("diagonal").alias("panel"),
        "x",
        F.lit(None).cast("double").alias("y"),
        F.col("density").alias("value"),
    )
    below = [(x, y) for k, y in enumerate(columns) for x in columns[:k]]
    if kind == "kde":
        off = kde_2d(rows, below, grid).select(
            "y_column", "x_column", F.lit("kde").alias("panel"), "x", "y", F.col("density").alias("value")
        )
    else:
        points = _pair_rows(rows, below).groupBy("y_column", "x_column", "px", "py").agg(F.count(F.lit(1)).alias("n"))
        off = points.selectExpr(
            "y_column", "x_column", "'scatter' AS panel", "px AS x", "py AS y", "CAST(n AS DOUBLE) AS value"
        )
    return diagonal.unionByName(off)
