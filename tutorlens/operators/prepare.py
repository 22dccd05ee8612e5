"""A fitted preparation (C1-C11): what is learned from one set of enrolments, kept for later ones.

``Preparation.fit`` learns the medians that fill gaps, the levels of the category
columns and the class codes; the model applies them to any table with the same
columns: next term's students are filled and encoded exactly as last term's were.
It is a ``pyspark.ml`` estimator, so it can stand in a ``Pipeline`` and be saved.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlens.functions.lookup import TARGET_CODES, map_lookup
from tutorlens.functions.sqltext import ident, literal
from tutorlens.operators import encode
from tutorlens.operators.quantiles import quantiles


class _Columns(Params):
    """Which columns are filled by their median, encoded, and turned into the class code."""

    medianColumns = Param(Params._dummy(), "medianColumns", "columns whose gaps the fitted median fills", TypeConverters.toListString)
    categoryColumns = Param(Params._dummy(), "categoryColumns", "columns encoded one-hot", TypeConverters.toListString)
    labelColumn = Param(Params._dummy(), "labelColumn", "column of the class label ('' for none)", TypeConverters.toString)
    targetColumn = Param(Params._dummy(), "targetColumn", "column of the class code", TypeConverters.toString)
    dropFirst = Param(Params._dummy(), "dropFirst", "leave out the first level of each column", TypeConverters.toBoolean)


class Preparation(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, levels (at most ``maxLevels`` in all) and class codes from a table of enrolments."""

    maxLevels = Param(Params._dummy(), "maxLevels", "most levels of all category columns together", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, medianColumns=None, categoryColumns=None, labelColumn="final_result", targetColumn="target", dropFirst=False, maxLevels=10_000):
        super().__init__()
        self._setDefault(
            medianColumns=["date_registration"], categoryColumns=list(encode.CATEGORY_COLUMNS), labelColumn="final_result",
            targetColumn="target", dropFirst=False, maxLevels=10_000,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "PreparationModel":
        medians = {}
        for c in self.getOrDefault(self.medianColumns):
            row = quantiles(dataset, c, [0.5], names=["median"]).first()
            medians[c] = row["median"] if row else None
        columns = self.getOrDefault(self.categoryColumns)
        # one more than may be: a table with too many is known without collecting them
        pairs = encode.level_pairs(dataset, columns).limit(self.getOrDefault(self.maxLevels) + 1).collect() if columns else []
        if len(pairs) > self.getOrDefault(self.maxLevels):
            raise ValueError(f"more than {self.getOrDefault(self.maxLevels)} levels in {columns}")
        levels = {c: sorted(r["v"] for r in pairs if r["i"] == i) for i, c in enumerate(columns)}
        model = PreparationModel()._set(medians=medians, levels=levels, classes=dict(TARGET_CODES))
        kept = (self.medianColumns, self.categoryColumns, self.labelColumn, self.targetColumn, self.dropFirst)
        return model._set(**{p.name: self.getOrDefault(p) for p in kept})._resetUid(self.uid + "-model")


class PreparationModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Applies what was learned.  Levels are kept as text."""

    medians = Param(Params._dummy(), "medians", "median of each filled column")
    levels = Param(Params._dummy(), "levels", "sorted levels of each category column")
    classes = Param(Params._dummy(), "classes", "class code of each label")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The other columns with their gaps filled, the dummies of the learned levels, ``n_unseen`` and the class code.

        A level that the fit did not see sets no dummy and counts in n_unseen; a
        missing one sets none.  A gap stays where the fit saw no value.  A label
        without code, and a missing one, has no class.
        """
        medians, levels = self.getOrDefault(self.medians), self.getOrDefault(self.levels)
        columns, label = self.getOrDefault(self.categoryColumns), self.getOrDefault(self.labelColumn)
        filled = dataset.withColumns(
            {c: F.coalesce(F.col(ident(c)), F.lit(m).cast(dataset.schema[c].dataType)) for c, m in medians.items() if m is not None}
        )
        known = lambda c: f"CAST({ident(c)} AS STRING) IN ({', '.join(literal(v) for v in levels[c])})" if levels[c] else "FALSE"
        unseen = " + ".join(f"IF({ident(c)} IS NOT NULL AND NOT {known(c)}, 1, 0)" for c in columns) or "0"
        kept = [ident(c) for c in dataset.columns if c not in columns and c != label]
        dummies = [
            f"coalesce(CAST({ident(c)} AS STRING) = {literal(v)}, FALSE) AS {ident(encode.dummy_name(c, v))}"
            for c in columns
            for v in levels[c][1 if self.getOrDefault(self.dropFirst) else 0 :]
        ]
        out = filled
        extra = [f"{unseen} AS n_unseen"]
        if label:
            target = self.getOrDefault(self.targetColumn)
            out = out.withColumn("_target", map_lookup(label, self.getOrDefault(self.classes)).cast("int"))
            extra.append(f"_target AS {ident(target)}")
        return out.selectExpr(*kept, *dummies, *extra)
