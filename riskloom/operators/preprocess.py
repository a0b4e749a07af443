"""Leak-free preprocessing as a Spark ML estimator: fitted on the training rows, frozen afterwards.

Numeric: median, Tukey fences learned after imputation, then centre and scale by the population
deviation. Categorical: most frequent value, then one column per category; unseen values give zeros.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import chunked, local_rows, named, numeric_columns, other_columns, quoted, sql_number, sql_string
from riskloom.functions.ranges import column_profile, order_statistics, quantiles
from riskloom.operators.alignment import align_lenient
from riskloom.operators.dictionary import build_dictionary, level_counts, level_summary, read_dictionary, with_places

log = logging.getLogger(__name__)

#: Levels of a column that a model holds itself; beyond that they are a table.
HELD_LEVELS = 50_000


def medians(df: DataFrame, columns: Sequence[str], profile: dict | None = None) -> dict[str, float | None]:
    return {c: q[0] for c, q in quantiles(df, {c: [0.5] for c in columns}, profile).items()}


def _fence(q1: float, q3: float, factor: float) -> tuple[float, float]:
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def tukey_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    found = quantiles(df, {c: [0.25, 0.75] for c in columns})
    return {c: _fence(q1, q3, factor) for c, (q1, q3) in found.items() if q1 is not None}


def imputed_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5
                   ) -> tuple[dict[str, float | None], dict[str, tuple[float, float]]]:
    """(medians, fences of the median-filled columns) from one search for order statistics.

    Filling inserts one copy of the median per missing row right behind the lower middle value, so a
    rank of the filled column maps to a rank of the present values and no second scan is needed.
    """
    profile = column_profile(df, columns, moments=False)
    ranks: dict[str, list[int]] = {}
    for c, p in profile.items():
        if p["n"]:
            n, gone = p["n"], p["rows"] - p["n"]
            middle = (n - 1) // 2
            at = [middle, n // 2]
            for share in (0.25, 0.75):
                place = (n + gone - 1) * share
                at += [r if r <= middle else r - gone for r in (math.floor(place), math.ceil(place))
                       if r <= middle or r > middle + gone]
            ranks[c] = sorted(set(at))
    values = order_statistics(df, ranks, profile)
    centre: dict[str, float | None] = dict.fromkeys(columns)
    fences = {}
    for c in ranks:
        n, gone = profile[c]["n"], profile[c]["rows"] - profile[c]["n"]
        middle = (n - 1) // 2
        half = (n - 1) * 0.5 - middle
        centre[c] = values[c][middle] + (values[c][n // 2] - values[c][middle]) * half

        def filled(rank: int) -> float:
            if rank <= middle:
                return values[c][rank]
            return centre[c] if rank <= middle + gone else values[c][rank - gone]

        quartiles = []
        for share in (0.25, 0.75):
            place = (n + gone - 1) * share
            low, high = filled(math.floor(place)), filled(math.ceil(place))
            quartiles.append(low + (high - low) * (place - math.floor(place)))
        fences[c] = _fence(*quartiles, factor)
    return centre, fences


def clipped(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def moments(df: DataFrame, values: dict[str, Column | str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per expression; a constant column gets deviation 1."""
    out = {}
    for part in chunked(list(values), 100):
        made = df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(f"x{i}")
                           for i, e in enumerate(values[c] for c in part)])
        row = made.selectExpr(*[f"avg(x{i}) AS m{i}" for i in range(len(part))],
                              *[f"stddev_pop(x{i}) AS s{i}" for i in range(len(part))]).first()
        for i, c in enumerate(part):
            out[c] = (row[f"m{i}"], row[f"s{i}"] or 1.0)
    return out


def _sql_filled(name: str, median: float) -> str:
    return f"coalesce(CAST({quoted(name)} AS DOUBLE), {sql_number(median)})"


def _sql_clipped(value: str, low: float, high: float) -> str:
    return f"greatest(least({value}, {sql_number(high)}), {sql_number(low)})"


def category_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest among ties; columns without values are left out."""
    return {r["name"]: r["mode"] for r in level_summary(level_counts(df, columns)).collect()}


def category_levels(df: DataFrame, columns: Sequence[str], held: int = HELD_LEVELS
                    ) -> tuple[dict[str, str], dict[str, list[str]], dict[str, tuple[int, int]], str | None]:
    """Mode (smallest among ties) per column; sorted levels of the columns with at most ``held`` of them; of the others
    the numbers of levels and rows, and the path of their dictionary. At most ``held`` values a column reach the driver."""
    counts = level_counts(df, columns)
    some = counts.limit(held * len(columns) + 1).toArrow()
    found: dict[str, dict[str, int]] = {c: {} for c in columns}
    if some.num_rows <= held * len(columns):
        for name, value, n in zip(*some.to_pydict().values()):
            found[name][value] = n
    if some.num_rows <= held * len(columns) and all(len(v) <= held for v in found.values()):
        return ({c: min(v, key=lambda k: (-v[k], k)) for c, v in found.items() if v},
                {c: sorted(v) for c, v in found.items() if v}, {}, None)
    seen = {r["name"]: r for r in level_summary(counts).collect()}
    wide = {c: (r["levels"], r["rows"]) for c, r in seen.items() if r["levels"] > held}
    levels: dict[str, list[str]] = {c: [] for c in seen if c not in wide}
    if levels:
        for name, value, _ in zip(*level_counts(df, list(levels)).toArrow().to_pydict().values()):
            levels[name].append(value)
    return ({c: r["mode"] for c, r in seen.items()}, {c: sorted(v) for c, v in levels.items()}, wide,
            build_dictionary(level_counts(df, list(wide))))


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "input columns in model order", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of transformed columns", TypeConverters.toString)

    def getInputCols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))

    def getOutputCol(self) -> str:
        return self.getOrDefault(self.outputCol)


class TabularPreprocessor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns every constant the model needs; small result sets reach the driver, of a categorical column at most
    ``heldLevels`` levels. The levels of wider columns are a ranked table that the model points to."""

    iqrFactor = Param(Params._dummy(), "iqrFactor", "width of the Tukey fences", TypeConverters.toFloat)
    heldLevels = Param(Params._dummy(), "heldLevels", "levels of a column that the model itself holds", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", iqrFactor=1.5, heldLevels=HELD_LEVELS):
        super().__init__()
        self._setDefault(outputCol="features", iqrFactor=1.5, heldLevels=HELD_LEVELS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TabularPreprocessorModel:
        columns = self.getInputCols()
        frame = dataset.select(*[named(c) for c in columns])
        numeric, categorical = numeric_columns(frame), other_columns(frame)
        centre, fences = imputed_fences(frame, numeric, self.getOrDefault(self.iqrFactor)) if numeric else ({}, {})
        for c in [c for c in numeric if centre[c] is None]:
            log.warning("column %s has no values in the training rows and is left out", c)
        numeric = [c for c in numeric if centre[c] is not None]
        spread = moments(frame, {c: _sql_clipped(_sql_filled(c, centre[c]), *fences[c]) for c in numeric}
                         ) if numeric else {}
        mode, levels, wide, path = category_levels(frame, categorical, self.getOrDefault(self.heldLevels)) if categorical else ({}, {}, {}, None)
        model = TabularPreprocessorModel()
        model._set(
            inputCols=columns, outputCol=self.getOutputCol(), numericCols=numeric,
            medians=[centre[c] for c in numeric], lower=[fences[c][0] for c in numeric],
            upper=[fences[c][1] for c in numeric], means=[spread[c][0] for c in numeric],
            deviations=[spread[c][1] for c in numeric],
            categoricalCols=[c for c in categorical if c in mode], modes=[mode[c] for c in categorical if c in mode],
            levels=[levels.get(c) for c in categorical if c in mode], wide={c: list(v) for c, v in wide.items()}, dictionaryPath=path or "",
            types={f.name: f.dataType.simpleString() for f in frame.schema.fields},
        )
        return model


class _ModelWriter(DefaultParamsWriter):
    """The dictionary of wide columns goes with the constants."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if own := self.instance.getOrDefault(self.instance.dictionaryPath):
            read_dictionary(self.sparkSession, own).write.partitionBy("name").parquet(f"{path}/dictionary")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.getOrDefault(model.dictionaryPath):
            model._set(dictionaryPath=f"{path}/dictionary")
        return model


class TabularPreprocessorModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Applies stored constants only: one projection, no job; wide columns are joined with their dictionary."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "imputation values", TypeConverters.toListFloat)
    lower = Param(Params._dummy(), "lower", "lower fences", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper fences", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "scales", TypeConverters.toListFloat)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical inputs", TypeConverters.toListString)
    modes = Param(Params._dummy(), "modes", "imputation categories", TypeConverters.toListString)
    levels = Param(Params._dummy(), "levels", "categories per column, null where a dictionary has them", TypeConverters.identity)
    wide = Param(Params._dummy(), "wide", "numbers of levels and rows of the columns in the dictionary", TypeConverters.identity)
    dictionaryPath = Param(Params._dummy(), "dictionaryPath", "where the dictionary is, if any", TypeConverters.toString)
    types = Param(Params._dummy(), "types", "input types", TypeConverters.identity)

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)

    def feature_types(self) -> tuple[list[str], list[str]]:
        """(numeric, categorical) as fitted, which is what monitoring must go by."""
        return list(self.getOrDefault(self.numericCols)), list(self.getOrDefault(self.categoricalCols))

    def input_names(self) -> list[str]:
        return self.getInputCols()

    def output_size(self) -> int:
        wide = self.getOrDefault(self.wide)
        return len(self.feature_types()[0]) + sum(
            wide[c][0] if vs is None else len(vs) for c, vs in zip(self.feature_types()[1], self.getOrDefault(self.levels)))

    def output_table(self, spark) -> DataFrame:
        """``(position, name)`` of every output, also those of wide columns."""
        numeric, categorical = self.feature_types()
        rows, wide, at = [(n, c) for n, c in enumerate(numeric)], [], len(numeric)
        for c, vs in zip(categorical, self.getOrDefault(self.levels)):
            if vs is None:
                wide.append((c, at))
            rows += [(at + n, f"{c}_{v}") for n, v in enumerate(vs or [])]
            at += self.getOrDefault(self.wide)[c][0] if vs is None else len(vs)
        out = local_rows(spark, rows, "position long, name string")
        if wide:
            levels = read_dictionary(spark, self.getOrDefault(self.dictionaryPath)).join(
                local_rows(spark, wide, "name string, start long"), "name")
            out = out.unionByName(levels.select((F.col("start") + F.col("place")).alias("position"),
                                                F.concat_ws("_", "name", "value").alias("name")))
        return out

    def _held_only(self) -> None:
        if names := [c for c, vs in zip(self.feature_types()[1], self.getOrDefault(self.levels)) if vs is None]:
            raise ValueError(f"columns with too many levels to name one by one: {names}; use transform and output_table")

    def output_names(self) -> list[str]:
        self._held_only()
        numeric, categorical = self.feature_types()
        return numeric + [f"{c}_{v}" for c, vs in zip(categorical, self.getOrDefault(self.levels)) for v in vs]

    def numeric_expressions(self) -> dict[str, str]:
        out: dict[str, str] = {}
        stats = zip(*[self.getOrDefault(p) for p in (
            self.numericCols, self.medians, self.lower, self.upper, self.means, self.deviations)])
        for c, median, low, high, mean, deviation in stats:
            value = _sql_clipped(_sql_filled(c, median), low, high)
            out[c] = f"({value} - {sql_number(mean)}) / {sql_number(deviation)}"
        return out

    def sql_expressions(self) -> dict[str, str]:
        self._held_only()
        out = self.numeric_expressions()
        for c, mode, levels in zip(*[self.getOrDefault(p) for p in (self.categoricalCols, self.modes, self.levels)]):
            value = f"coalesce(CAST({quoted(c)} AS STRING), {sql_string(mode)})"
            for v in levels:
                out[f"{c}_{v}"] = f"CAST({value} = {sql_string(v)} AS DOUBLE)"
        return out

    def expressions(self) -> dict[str, Column]:
        """One column per output name."""
        return {name: F.expr(e) for name, e in self.sql_expressions().items()}

    def align(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        inputs = self.getInputCols()
        return align_lenient(df, [*[c for c in keep if c not in inputs], *inputs], self.getOrDefault(self.types))

    def transform_columns(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Flat form: one double column per output name."""
        return df.select(*[named(c) for c in keep], *[e.alias(n) for n, e in self.expressions().items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """One vector column. Categories are found by an index map and stay sparse, however many levels there are."""
        numeric, categorical = self.feature_types()
        exprs = self.numeric_expressions()
        numbers = array_to_vector(F.expr(f"array({', '.join(exprs[c] for c in numeric)})")) if numeric else None
        if not categorical:
            return dataset.withColumn(self.getOutputCol(), numbers)
        made = {f"__value{i}": F.expr(f"coalesce(CAST({quoted(c)} AS STRING), {sql_string(mode)})")
                for i, (c, mode) in enumerate(zip(categorical, self.getOrDefault(self.modes)))}
        if numeric:
            made["__numbers"] = numbers
        places, flags = ([f"__{k}{i}" for i in range(len(categorical))] for k in ("place", "flag"))
        indexed = dataset.withColumns(made)
        every, wide = self.getOrDefault(self.levels), self.getOrDefault(self.wide)
        sought = {places[i]: (c, F.col(f"__value{i}")) for i, c in enumerate(categorical) if every[i] is None}
        if sought:
            dictionary = read_dictionary(dataset.sparkSession, self.getOrDefault(self.dictionaryPath))
            indexed = with_places(indexed, sought, dictionary, {c: rows for c, (_, rows) in wide.items()})
        for i, levels in enumerate(every):  # one by one: lists of unequal length would be filled up
            size = wide[categorical[i]][0] if levels is None else len(levels)
            if levels is None:
                indexed = indexed.withColumn(places[i], F.coalesce(F.col(places[i]), F.lit(size)).cast("double"))
            else:
                indexed = StringIndexerModel.from_labels(levels, f"__value{i}", places[i], "keep").transform(indexed)
            # the number of places without their names, of which an empty one would be refused
            indexed = indexed.withMetadata(places[i], {"ml_attr": {"type": "nominal", "num_vals": size + 1}})
        # the place behind the last level, that of unseen values, is the one that the encoder drops
        encoded = OneHotEncoder(inputCols=places, outputCols=flags, dropLast=True).fit(indexed).transform(indexed)
        if numeric:
            encoded = VectorSizeHint(inputCol="__numbers", size=len(numeric), handleInvalid="optimistic").transform(encoded)
        whole = VectorAssembler(inputCols=["__numbers"] * bool(numeric) + flags, outputCol=self.getOutputCol(), handleInvalid="keep")
        # without the encoder's marks, which would make trees treat the flags as indexed categories
        return whole.transform(encoded).drop(*made, *places, *flags).withMetadata(self.getOutputCol(), {})
