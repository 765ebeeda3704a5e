"""How strong a composition will be in the next version, from how strong it was in earlier ones."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.scalars import version_order
from matchloom.operators.containment import canonical
from matchloom.operators.outcome import mean_place, tally
from matchloom.session import staged

KEY = ["level", "itemsets"]
MIN_BOARDS = 5


def strengths(comps: DataFrame, min_boards: int = MIN_BOARDS, units: str = "combine_units") -> DataFrame:
    """Mean placement of each unit set by version and level, and the version's number in order; rare sets are left out."""
    counted = tally(comps.withColumn("itemsets", canonical(F.col(units))), ["game_version", *KEY])
    counted = counted.filter(F.col("n_placed") >= min_boards)
    # a row a version
    in_order = Window.orderBy(*version_order())
    versions = comps.select("game_version").na.drop().distinct().withColumn("version_no", F.row_number().over(in_order))
    return counted.join(F.broadcast(versions), "game_version").select("game_version", "version_no", *KEY, "n_placed", mean_place().alias("place"))


def with_last(strength: DataFrame) -> DataFrame:
    """Sets that the version before had too, with their mean placement there as ``last_place``."""
    before = strength.select((F.col("version_no") + 1).alias("version_no"), *KEY, F.col("place").alias("last_place"))
    return strength.join(before, ["version_no", *KEY])


def fitted(pairs: DataFrame) -> LinearRegressionModel:
    """Least squares of a set's mean placement on that of the version before."""
    rows = VectorAssembler(inputCols=["last_place"], outputCol="features").transform(pairs.select("last_place", "place"))
    return LinearRegression(labelCol="place", solver="normal", standardization=False).fit(rows)


def forecast(strength: DataFrame) -> DataFrame | None:
    """The sets of the last version with the placement to expect in the next; the line is fitted on all versions.

    None if fewer than two sets were there in two versions in a row.
    """
    pairs = staged(with_last(strength), "pairs")
    if pairs.limit(2).count() < 2:
        return None
    model = fitted(pairs)
    last = strength.agg(F.max("version_no")).first()[0]
    expected = F.lit(float(model.coefficients[0])) * F.col("place") + F.lit(float(model.intercept))
    return strength.filter(F.col("version_no") == last).select("game_version", *KEY, "place", expected.alias("expected_place"))


def held_out_error(strength: DataFrame) -> DataFrame:
    """slope, intercept, fitted on all versions but the last, and on the last one the root mean squared error of the
    line and of taking a set's placement for unchanged. Numbers are NULL where there is nothing to fit or to test.
    """
    pairs = staged(with_last(strength), "pairs")
    last = strength.agg(F.max("version_no")).first()[0] or 0
    train, test = pairs.filter(F.col("version_no") < last), pairs.filter(F.col("version_no") == last)
    slope = intercept = None
    if train.limit(2).count() == 2:
        model = fitted(train)
        slope, intercept = float(model.coefficients[0]), float(model.intercept)
    line = F.lit(slope).cast("double") * F.col("last_place") + F.lit(intercept).cast("double")

    def error(expected):
        return F.sqrt(F.avg((F.col("place") - expected) ** 2))

    return test.agg(
        F.lit(slope).cast("double").alias("slope"),
        F.lit(intercept).cast("double").alias("intercept"),
        F.count("*").alias("n_tested"),
        error(line).alias("error"),
        error(F.col("last_place")).alias("error_unchanged"),
    )
