"""Category dictionary, one-hot, scaling and the page feature pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.functions.prep import clamp_nonneg, strip_quotes
from orchard.operators.common import dense_numbers, join_small, lit_array

# Up to this many slots a dense row is one expression per slot; above it, one expression
# over an array, with the same numbers.
INLINE_LOOKUP_MAX = 64


@dataclass
class CategoryIndex:
    """Distinct categories numbered 0..k-1 in ascending order (A4)."""

    table: DataFrame          # (category string, idx int), k rows, any number of them
    size: int
    values: list[str] | None = None     # of a dictionary that is on the driver as well

    @property
    def categories(self) -> list[str]:
        """All categories in order, on the driver."""
        if self.values is None:
            self.values = [r["category"] for r in self.table.orderBy("idx").collect()]
        return self.values

    def slot(self, key: Column) -> Column:
        """Inline slot expression (small dictionaries only)."""
        out = None
        for i, c in enumerate(self.categories):
            out = (F.when(key == F.lit(c), F.lit(i)) if out is None
                   else out.when(key == F.lit(c), F.lit(i)))
        return out if out is not None else F.lit(None).cast("int")

    def lookup(self, df: DataFrame, col: str, out: str = "cat_idx",
               on_unknown: str = "error", strip: bool = True) -> DataFrame:
        """Attach the slot of ``col`` (J1).  Unknown: ``'error'`` or ``'zero'``."""
        key = strip_quotes(col) if strip else F.col(col)
        if self.values is not None and self.size <= INLINE_LOOKUP_MAX:
            j = df.withColumn(out, self.slot(key))
        else:
            d = self.table.withColumnRenamed("idx", out)
            j = join_small(df.withColumn("__cat", key),
                           d.withColumnRenamed("category", "__cat"),
                           "__cat", "left", small_rows=self.size).drop("__cat")
        if on_unknown not in ("error", "zero"):
            raise ValueError(f"on_unknown must be 'error' or 'zero', not {on_unknown!r}")
        if on_unknown == "error":
            j = j.withColumn(out, F.when(F.col(out).isNull(), F.raise_error(
                F.concat(F.lit("unknown category: "), F.col(col).cast("string"))))
                .otherwise(F.col(out)))
        return j

    def one_hot(self, idx_col: str = "cat_idx") -> Column:
        """Dense indicator block of k slots, none dropped (F1)."""
        return one_hot(idx_col, self.size)

    def one_hot_slots(self, idx_col: str = "cat_idx") -> list[Column]:
        idx = F.col(idx_col)
        return [F.when(idx == F.lit(i), F.lit(1.0)).otherwise(F.lit(0.0))
                for i in range(self.size)]


def one_hot(idx_col: str | Column, k: int) -> Column:
    """k indicator slots as one array; each slot is its own codegen'd expression."""
    idx = F.col(idx_col) if isinstance(idx_col, str) else idx_col
    if k <= 0:
        return F.array().cast("array<double>")
    if k > INLINE_LOOKUP_MAX:       # one expression instead of k
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                           lambda i: F.when(i == idx, 1.0).otherwise(0.0))
    return F.array(*[F.when(idx == F.lit(i), F.lit(1.0)).otherwise(F.lit(0.0))
                     for i in range(k)])


def _dictionary(spark, values: list[str]) -> CategoryIndex:
    schema = T.StructType([T.StructField("category", T.StringType(), False),
                           T.StructField("idx", T.IntegerType(), False)])
    table = spark.createDataFrame(list(zip(values, range(len(values)))), schema)
    return CategoryIndex(table, len(values), values)


def fit_category_index(df: DataFrame, col: str, strip: bool = True,
                       max_categories: int | None = None) -> CategoryIndex:
    """Number the distinct values of ``col`` (quotes stripped) in value order, however many.

    One distributed distinct, sorted by range partitions and numbered there; the
    dictionary stays a table.  ``max_categories`` refuses a longer one, if given.
    """
    key = strip_quotes(col) if strip else F.col(col)
    cats = df.select(key.alias("category")).where(F.col("category").isNotNull()).distinct()
    table = dense_numbers(cats, "category", "idx")
    size = table.count()
    if max_categories is not None and size > max_categories:
        raise ValueError(f"{col} has more than {max_categories} distinct values")
    return CategoryIndex(table, size)


@dataclass
class ScalerModel:
    """Per-feature mean and sample standard deviation."""

    mean: list[float]
    std: list[float]
    with_mean: bool = True
    with_std: bool = True

    def scale_factors(self) -> tuple[list[float], list[float]]:
        scale = [(1.0 / s if s != 0.0 else 0.0) if self.with_std else 1.0 for s in self.std]
        shift = self.mean if self.with_mean else [0.0] * len(self.mean)
        return shift, scale

    def scale_slots(self, slots: Sequence[Column]) -> list[Column]:
        """(x - mean) * (1/std), or x * (1/std); a constant feature gives 0.0."""
        shift, scale = self.scale_factors()
        return [(x - F.lit(float(m))) * F.lit(float(s)) for x, m, s in zip(slots, shift, scale)]

    def scale_array(self, x: Column) -> Column:
        """``scale_slots`` over an array, as one expression whatever its length."""
        shift, scale = self.scale_factors()
        both = F.arrays_zip(lit_array(shift).alias("m"), lit_array(scale).alias("s"))
        return F.zip_with(x, both, lambda v, t: (v - t["m"]) * t["s"])

    def transform_col(self, features: str | Column = "features") -> Column:
        x = F.col(features) if isinstance(features, str) else features
        return F.array(*self.scale_slots([x.getItem(j) for j in range(len(self.mean))]))

    def transform(self, df: DataFrame, features: str = "features",
                  out: str | None = None) -> DataFrame:
        return df.withColumn(out or features, self.transform_col(features))

    def stats_frame(self, spark) -> DataFrame:
        rows = [(j, float(m), float(s)) for j, (m, s) in enumerate(zip(self.mean, self.std))]
        return spark.createDataFrame(rows, "j int, mean double, std double")


def fit_scaler(df: DataFrame, dim: int, features: str = "features",
               with_mean: bool = True, with_std: bool = True) -> ScalerModel:
    """One distributed aggregate (partial per partition) of mean and std."""
    from orchard.operators import common
    if dim > common.WIDE_DIM:
        long = df.select(F.posexplode_outer(features).alias("j", "v")).where(F.col("j").isNotNull())
        rows = long.groupBy("j").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).collect()
        by = {int(r["j"]): r for r in rows}
        mean = [float(by[j]["m"] or 0.0) if j in by else 0.0 for j in range(dim)]
        std = [float(by[j]["s"]) if j in by and by[j]["s"] is not None else 0.0
               for j in range(dim)]
        return ScalerModel(mean, std, with_mean, with_std)
    x = F.col(features)
    aggs = []
    for j in range(dim):
        aggs += [F.avg(x.getItem(j)).alias(f"m{j}"), F.stddev_samp(x.getItem(j)).alias(f"s{j}")]
    row = df.agg(*aggs).first()
    mean = [float(row[f"m{j}"] or 0.0) for j in range(dim)]
    std = [float(row[f"s{j}"]) if row[f"s{j}"] is not None else 0.0 for j in range(dim)]
    return ScalerModel(mean, std, with_mean, with_std)


def numeric_slots(cols: Sequence[str], missing_to_zero: bool = True,
                  clamp: bool = False) -> list[Column]:
    """Numeric columns as slots; NULL (the parsed ``?``) becomes 0.0."""
    out = []
    for c in cols:
        v = F.col(c).cast("double")
        if missing_to_zero:
            v = F.coalesce(v, F.lit(0.0))
        if clamp:
            v = clamp_nonneg(v)
        out.append(v)
    return out


def numeric_block(cols: Sequence[str], missing_to_zero: bool = True,
                  clamp: bool = False) -> Column:
    return F.array(*numeric_slots(cols, missing_to_zero, clamp))


@dataclass
class PageFeatures:
    """Fitted page pipeline: dictionary -> one-hot ++ numbers -> scaler."""

    index: CategoryIndex
    numeric: list[str]
    scaler: ScalerModel | None
    clamp: bool = False
    on_unknown: str = "error"
    keep: list[str] = field(default_factory=list)

    @property
    def dim(self) -> int:
        return self.index.size + len(self.numeric)

    def _raw(self) -> Column | list[Column]:
        """Slots one by one, or, where there are many, as one array expression."""
        nums = numeric_slots(self.numeric, clamp=self.clamp)
        if self.index.size <= INLINE_LOOKUP_MAX:
            return self.index.one_hot_slots("cat_idx") + nums
        return F.concat(self.index.one_hot("cat_idx"), F.array(*nums))

    def assemble(self, df: DataFrame, category: str = "category") -> DataFrame:
        """Unscaled features (P10)."""
        j = self.index.lookup(df, category, on_unknown=self.on_unknown)
        raw = self._raw()
        return j.withColumn("features", F.array(*raw) if isinstance(raw, list) else raw).drop("cat_idx")

    def transform(self, df: DataFrame, category: str = "category") -> DataFrame:
        j = self.index.lookup(df, category, on_unknown=self.on_unknown)
        raw = self._raw()
        if isinstance(raw, list):
            raw = F.array(*(raw if self.scaler is None else self.scaler.scale_slots(raw)))
        elif self.scaler is not None:
            raw = self.scaler.scale_array(raw)
        return j.withColumn("features", raw).drop("cat_idx")


def _combine(parts: list[tuple[int, float, float]]) -> tuple[float, float]:
    """Pooled mean and sample std from per-group (n, mean, var_samp) (Chan et al.)."""
    n = sum(p[0] for p in parts)
    if n == 0:
        return 0.0, 0.0
    mean = sum(p[0] * p[1] for p in parts) / n
    m2 = sum((p[2] if p[0] > 1 else 0.0) * (p[0] - 1) + p[0] * (p[1] - mean) ** 2
             for p in parts)
    return mean, (m2 / (n - 1)) ** 0.5 if n > 1 else 0.0


def fit_page_features(df: DataFrame, numeric: Sequence[str], category: str = "category",
                      with_mean: bool = True, with_std: bool = True, clamp: bool = False,
                      on_unknown: str = "error", scale: bool = True,
                      fit_on: Column | None = None) -> PageFeatures:
    """Dictionary over all rows and scaler over the ``fit_on`` rows, in ONE pass.

    The dense form: every row will hold a slot per category, and so does the driver.  For a
    column whose number of values is not known to be small, ``sparse.fit_sparse_pages`` gives
    the same models with the categories as a table; pages are fitted that way.

    One ``groupBy(category)`` aggregate (partial per partition) yields, per
    category, its count among the scaler rows and the mean / variance of every
    numeric column; the one-hot statistics follow from the counts and the
    numeric ones are pooled on the driver.  Fitting the scaler on the training
    split keeps test rows out of mean / std; ``fit_on=None`` uses every row.
    """
    key = strip_quotes(category)
    fit = fit_on if fit_on is not None else F.lit(True)
    nums = numeric_slots(numeric, clamp=clamp)
    aggs = [F.count_if(fit).alias("n")]
    for j, v in enumerate(nums):
        w = F.when(fit, v)
        aggs += [F.avg(w).alias(f"m{j}"), F.var_samp(w).alias(f"v{j}")]
    g = df.groupBy(key.alias("category")).agg(*aggs)
    rows = g.orderBy(F.asc_nulls_last("category")).collect()
    values = [r["category"] for r in rows if r["category"] is not None]
    index = _dictionary(df.sparkSession, values)
    pf = PageFeatures(index, list(numeric), None, clamp, on_unknown)
    if scale:
        n = sum(int(r["n"]) for r in rows)
        mean, std = [], []
        for r in rows:                       # one-hot slots: Bernoulli(n_c / n)
            if r["category"] is None:
                continue
            nc = int(r["n"])
            p = nc / n if n else 0.0
            mean.append(p)
            m2 = nc * (1.0 - p) ** 2 + (n - nc) * p * p
            std.append((m2 / (n - 1)) ** 0.5 if n > 1 else 0.0)
        for j in range(len(nums)):
            parts = [(int(r["n"]), float(r[f"m{j}"] or 0.0), float(r[f"v{j}"] or 0.0))
                     for r in rows if int(r["n"]) > 0]
            m, s = _combine(parts)
            mean.append(m)
            std.append(s)
        pf.scaler = ScalerModel(mean, std, with_mean, with_std)
    return pf
