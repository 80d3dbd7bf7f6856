"""Aggregates over facts that carry a weight.

A reading belongs to a home, and the home dimension has one row per meter, so the home-level
join repeats every reading once per meter of its home. Facts keep that number in ``fan_out``
instead of being repeated: a weighted sum over n rows equals the plain sum over the repeated
rows, and a home with many meters costs no more than any other.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN_OUT = "fan_out"


def _weight() -> Column:
    return F.col(FAN_OUT)


def rows() -> Column:
    """COUNT(*)"""
    return F.coalesce(F.sum(_weight()), F.lit(0).cast("bigint"))


def rows_if(condition: Column) -> Column:
    """COUNT of the rows for which the condition is true"""
    return F.coalesce(F.sum(F.when(condition, _weight())), F.lit(0).cast("bigint"))


def rows_of(column: str) -> Column:
    """COUNT(column)"""
    return rows_if(F.col(column).isNotNull())


def total(value: Column | str) -> Column:
    """SUM(value)"""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value * _weight())


def mean(value: Column | str) -> Column:
    """AVG(value)"""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_divide(total(value), F.sum(F.when(value.isNotNull(), _weight())))


# Spreads and correlations in two steps. Rows of equal weight are aggregated by the built-in functions, whose partial
# results merge without cancellation. Each group has a few such parts, one per weight; their state (count, mean, moments)
# is moved to the common mean of the group, after which the parts merge by plain sums.


def _moments(values: dict[str, Column]) -> Column:
    fields = [F.count(next(iter(values.values()))).alias("n")]
    for name, value in values.items():
        fields += [F.avg(value).alias(name), F.var_pop(value).alias(name * 2), F.min(value).alias(f"{name}_low"), F.max(value).alias(f"{name}_high")]
    if len(values) == 2:
        fields.append(F.covar_pop(*values.values()).alias("xy"))
    return F.struct(*fields)


def parts(df: DataFrame, keys: list, *columns: str, pairs: tuple[tuple[str, str], ...] = (), more: tuple[Column, ...] = ()) -> DataFrame:
    """First step: mergeable state of columns and pairs by keys and weight, and any other aggregates.

    The state is taken around the mean of the group of `keys`, so the second step has to group by the same keys. The
    window that finds the mean holds one row for each different weight of a group.
    """
    wanted = {f"_m_{c}": {"x": F.col(c)} for c in columns}
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        wanted[f"_m_{a}_{b}"] = {"x": F.when(both, F.col(a)), "y": F.when(both, F.col(b))}
    grouped = df.groupBy(*keys, FAN_OUT).agg(F.count(F.lit(1)).alias("_rows"), *(_moments(v).alias(name) for name, v in wanted.items()), *more)
    group = Window.partitionBy(*grouped.columns[: len(keys)])
    return grouped.withColumns({name: _around_mean(F.col(name), list(values), group) for name, values in wanted.items()})


def _around_mean(part: Column, names: list[str], group) -> Column:
    """Weighted count, sums and moments of a part around the mean of its group."""
    n = _weight() * part["n"]
    off = {c: part[c] - F.try_divide(F.sum(n * part[c]).over(group), F.sum(n).over(group)) for c in names}
    fields = [n.alias("n"), *((n * part[c]).alias(c) for c in names)]
    for a, b in [(c, c) for c in names] + [("x", "y")] * (len(names) == 2):
        fields.append((n * (part[a + b] + off[a] * off[b])).alias(a + b))
    return F.struct(*fields, *(part[f"{c}_{end}"].alias(f"{c}_{end}") for c in names for end in ("low", "high")))


def part_rows() -> Column:
    """COUNT(*), second step"""
    return F.coalesce(F.sum(F.col("_rows") * _weight()), F.lit(0).cast("bigint"))


def part_mean(column: str) -> Column:
    """AVG(column), second step"""
    return F.try_divide(F.sum(f"_m_{column}.x"), F.sum(f"_m_{column}.n"))


def _moment(state: str, a: str, b: str) -> Column:
    """Sum of products of deviations from the common means; exactly 0 if one is constant."""
    constant = F.lit(False)
    for c in sorted({a, b}):
        constant |= F.min(f"{state}.{c}_low") == F.max(f"{state}.{c}_high")
    return F.when(constant, 0.0).otherwise(F.sum(f"{state}.{a}{b}"))


def part_stddev(column: str) -> Column:
    """Sample standard deviation, second step"""
    n = F.sum(f"_m_{column}.n")
    return F.sqrt(F.try_divide(_moment(f"_m_{column}", "x", "x"), F.when(n > 1, n - 1)))


def part_corr(left: str, right: str) -> Column:
    """Pearson correlation over the rows where both values are present, second step; null if one is constant."""
    state = f"_m_{left}_{right}"
    return F.try_divide(_moment(state, "x", "y"), F.sqrt(_moment(state, "x", "x")) * F.sqrt(_moment(state, "y", "y")))


def repeat(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """The repeated rows themselves, for row-level results."""
    copies = F.col(FAN_OUT) if at_most is None else F.least(F.col(FAN_OUT), F.lit(at_most))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).drop("_copy", FAN_OUT)


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n repeated rows in the given order. Every row stands for at least one, so the
    first n distinct rows contain them all."""
    return repeat(df.orderBy(*order).limit(n), n).orderBy(*order).limit(n)
