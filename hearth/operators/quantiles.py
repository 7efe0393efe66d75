"""Exact, linearly interpolated quantiles with bounded task state.

Spark's exact ``percentile`` merges a value -> count map per group in one task, which grows with
the distinct values.  Here a quantile sketch per group gives a narrow bracket around every requested
position.  Each value gets the number of its interval among the sorted bracket bounds; values
inside a bracket are counted one by one, the others per interval.  Where a bracket may hold more
than ``MOST`` different values it is narrowed: 64 splitters of its different values cut it into cells,
and only cells that hold a position stay open, until each holds at most ``MOST``.  The counts
alone decide the result; sketches and splitters only decide how much is counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.exprs import at_or_below, col_of
from hearth.session import cut_lineage

# Relative rank error of the sketch, and half the width of a bracket in multiples of it.
SKETCH_ACCURACY = 10_000
BRACKET = 20
# Different values of one bracket that the last step sorts in one task, and splitters of a narrowing.
MOST = 50_000
SPLITTERS = 63


def _join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL keys match (a NULL group is a group); one-row ``b`` without."""
    if not keys:
        return a.join(F.broadcast(b), how=how)
    br = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(br[f"__{k}"])
        cond = c if cond is None else cond & c
    return a.join(br, cond, how).drop(*[f"__{k}" for k in keys])


def _value(c: str | Column) -> Column:
    x = col_of(c).cast("double")
    return F.when(~F.isnan(x), x)


def _counted(df: DataFrame, base: DataFrame, by: list[str], specs: list) -> DataFrame:
    """``by, i, place, open, x, c, least, most``: cells of every group and column in the order of
    ``place`` and ``x``.  An open cell is one value inside a bracket, any other an interval."""
    rows = _join(df.select(*by, *[f"_v{i}" for i in range(len(specs))]), base.select(*by, *[f"_s{i}" for i in range(len(specs))]), by)

    def interval(i: int) -> Column:
        v, m = F.col(f"_v{i}"), len(specs[i][1])
        if m > 16:  # else compiled comparisons, which are faster
            lows, highs = F.slice(f"_s{i}", 1, m), F.slice(f"_s{i}", m + 1, m)
            above, below = at_or_below(lows, v, most=m), at_or_below(highs, v, strict=True, most=m)
        else:
            bounds = [F.get(f"_s{i}", F.lit(j)) for j in range(2 * m)]
            above = sum(((v >= e).cast("int") for e in bounds[1:m]), (v >= bounds[0]).cast("int"))
            below = sum(((v > e).cast("int") for e in bounds[m + 1:]), (v > bounds[m]).cast("int"))
        return F.struct(F.lit(i).alias("i"), v.alias("v"), above.alias("above"), below.alias("below"))

    each = [interval(i) for i in range(len(specs))]
    cells = rows.select(*by, (F.explode(F.array(*each)) if len(each) > 1 else each[0]).alias("_c")).select(*by, "_c.*").filter(F.col("v").isNotNull())
    cells = cells.select(*by, "i", (F.col("above") + F.col("below")).alias("place"), (F.col("below") < F.col("above")).alias("open"), "v")
    return cells.groupBy(*by, "i", "place", "open", F.when(F.col("open"), F.col("v")).alias("x")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))


def _wanted(specs: list) -> Column:
    """The positions (b, upper, k) that fall into a cell with ``at`` rows before it, of ``n`` rows."""
    probs = F.array(*[F.lit(p) for p in specs[0][1]])
    for i, (_, more, _) in enumerate(specs[1:], 1):
        probs = F.when(F.col("i") == i, F.array(*[F.lit(p) for p in more])).otherwise(probs)

    def positions(p: Column, b: Column) -> Column:
        h = (F.col("n") - 1) * p
        return F.array(*[F.struct(b.alias("b"), F.lit(up).alias("upper"), (F.ceil(h) if up else F.floor(h)).alias("k"), h.alias("h")) for up in (False, True)])

    return F.filter(F.flatten(F.transform(probs, positions)), lambda w: (F.col("at") <= w["k"]) & (w["k"] < F.col("at") + F.col("c")))


def _ranked(cells: DataFrame, by: list[str], *order: str) -> DataFrame:
    part = Window.partitionBy(*by, "i")
    before = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("at", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("n", F.sum("c").over(part))


def _found(cells: DataFrame, by: list[str], specs: list) -> DataFrame:
    """``by, i, b, upper, h, value``; the value is NULL where a bracket missed its position."""
    hits = _ranked(cells, by, "place", "x").withColumn("w", F.explode(_wanted(specs)))
    k = F.col("w.k")
    value = F.when(F.col("open"), F.col("x")).when(F.col("least") == F.col("most"), F.col("least")).when(k == F.col("at"), F.col("least")).when(
        k == F.col("at") + F.col("c") - 1, F.col("most"))
    return hits.select(*by, "i", "w.b", "w.upper", "w.h", value.alias("value"))


def _narrowed(cells: DataFrame, by: list[str], specs: list) -> DataFrame:
    """Cells of which no place has more than ``MOST`` open ones."""
    keys = [*by, "i", "place"]
    probs = [j / (SPLITTERS + 1) for j in range(1, SPLITTERS + 1)]
    while True:
        held = cells.filter("open").groupBy(*keys).agg(F.count(F.lit(1)).alias("held"), F.percentile_approx("x", probs, SKETCH_ACCURACY).alias("cuts"))
        held = cut_lineage(held)
        if (held.agg(F.max("held")).first()[0] or 0) <= MOST:
            return cells
        cut = _join(cells, held.select(*keys, F.array_distinct("cuts").alias("cuts")), keys, "left")
        cut = cut.withColumn("s", F.when(F.col("open"), at_or_below(F.col("cuts"), F.col("x"))).otherwise(F.lit(0))).drop("cuts")
        coarse = cut.groupBy(*keys, "s").agg(F.first("open").alias("open"), F.sum("c").alias("c"), F.min("least").alias("least"), F.max("most").alias("most"))
        coarse = _ranked(coarse, by, "place", "s").withColumn("next", F.row_number().over(Window.partitionBy(*by, "i").orderBy("place", "s")))
        coarse = coarse.withColumn("stays", F.col("open") & (F.col("least") < F.col("most")) & (F.size(_wanted(specs)) > 0))
        coarse = cut_lineage(coarse.select(*keys, "s", "next", "stays", "c", "least", "most"))
        shut = coarse.filter(~F.col("stays")).select(*by, "i", F.col("next").alias("place"), F.lit(False).alias("open"), F.lit(None).cast("double").alias("x"), "c", "least", "most")
        own = _join(cut, coarse.filter("stays").select(*keys, "s", "next"), [*keys, "s"])
        own = own.select(*by, "i", F.col("next").alias("place"), "open", "x", "c", "least", "most")
        cells = cut_lineage(shut.unionByName(own))


def with_quantiles(df: DataFrame, by: Sequence[str], aggs: list, qspecs: list, needs: Sequence[str] | None = None) -> DataFrame:
    """Grouped aggregate ``aggs`` plus quantile arrays ``qspecs`` =
    [(value column, probs, output name)]; NULL and NaN are no values, a group
    without values has a NULL array.

    ``needs`` names the columns that ``aggs`` read (None: all); they, the groups
    and the values are written first, since sketch and counts both read them."""
    by = list(by)
    specs = [(f"_v{i}", sorted({float(p) for p in probs}), name) for i, (_, probs, name) in enumerate(qspecs)]
    given = [[float(p) for p in probs] for _, probs, _ in qspecs]
    kept = dict.fromkeys([*by, *(df.columns if needs is None else needs)])
    df = cut_lineage(df.select(*[F.col(f"`{c}`") for c in kept], *[_value(c).alias(v) for (c, _, _), (v, _, _) in zip(qspecs, specs)]))
    width = BRACKET / SKETCH_ACCURACY
    bounded = 2.5 * width * df.count() <= MOST
    while True:
        sketches = [F.percentile_approx(v, [max(0.0, p - width) for p in probs] + [min(1.0, p + width) for p in probs], SKETCH_ACCURACY).alias(f"_s{i}")
                    for i, (v, probs, _) in enumerate(specs)]
        base = df.groupBy(*by).agg(*aggs, *sketches)
        if bounded:
            found = _found(_counted(df, base, by, specs), by, specs)
            break
        base = cut_lineage(base)
        cells = cut_lineage(_counted(df, base, by, specs))
        if width < 1 and not _found(cells, by, specs).filter("value is null").isEmpty():
            width *= 8
            continue
        found = _found(_narrowed(cells, by, specs), by, specs)
        break
    found = found.groupBy(*by, "i", "b").agg(F.max("h").alias("h"), F.max(F.when(~F.col("upper"), F.col("value"))).alias("lo"), F.max(F.when(F.col("upper"), F.col("value"))).alias("hi"))
    h, lo, hi = F.col("h"), F.col("lo"), F.col("hi")
    # same interpolation arithmetic as Spark's percentile aggregate
    q = F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).when(
        (F.ceil(h) == F.floor(h)) | (lo == hi), lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)
    found = found.select(*by, "i", F.struct("b", q.alias("q")).alias("s"))

    def array_of(i: int, name: str) -> Column:
        got = F.array_sort(F.collect_list(F.when(F.col("i") == i, F.col("s"))))  # one entry a probability
        places = [specs[i][1].index(p) for p in given[i]]
        in_order = F.transform(got, lambda s: s["q"])
        if places != list(range(len(places))):
            in_order = F.transform(F.array(*[F.lit(j) for j in places]), lambda j: F.get(F.transform(got, lambda s: s["q"]), j))
        return F.when(F.size(got) > 0, in_order).alias(name)

    table = found.groupBy(*by).agg(*[array_of(i, name) for i, (_, _, name) in enumerate(specs)])
    return _join(base.drop(*[f"_s{i}" for i in range(len(specs))]), table, by, "left")


def exact_quantiles(df: DataFrame, col: str | Column, probs: Sequence[float], by: Sequence[str] = (),
                    out: str = "q") -> DataFrame:
    """Quantiles (numpy/pandas default) per group as an array in ``probs``
    order: (by..., out); one row without groups."""
    return with_quantiles(df, by, [F.count(F.lit(1)).alias("_rows")], [(col, list(probs), out)], needs=[]).drop("_rows")


def quantile_columns(df: DataFrame, by: Sequence[str], aggs: list, columns: list, needs: Sequence[str] | None = None) -> DataFrame:
    """``with_quantiles`` for single quantiles [(value column, prob, output name)] as plain columns."""
    g = with_quantiles(df, by, aggs, [(c, [p], f"_q{i}") for i, (c, p, _) in enumerate(columns)], needs)
    return g.withColumns({name: F.get(f"_q{i}", F.lit(0)) for i, (_, _, name) in enumerate(columns)}).drop(
        *[f"_q{i}" for i in range(len(columns))])
