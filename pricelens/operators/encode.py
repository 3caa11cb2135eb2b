"""Category indexing, one-hot encoding and vector assembly with MLlib transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    OneHotEncoderModel,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.operators.columns import name_at
from pricelens.operators.ranking import sums_before
from pricelens.schemas import FEATURE_INDEX
from pricelens.session import join_on
from pricelens.sources.reports import rows_to_frame
from pricelens.storage import storage

MAX_LEVELS = 10_000


def index_suffix(column: str) -> str:
    return f"{column}_idx"


def one_hot_suffix(column: str) -> str:
    return f"{column}_ohe"


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per level of each column, all columns in one aggregation."""
    return (
        df.select(F.posexplode(F.array(*columns)).alias("position", "level"))
        .filter(F.col("level").isNotNull())
        .groupBy("position", "level")
        .agg(F.count("*").alias("n"))
        .select(name_at(columns, F.col("position")).alias("column"), "level", "n")
    )


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, level, n, idx``: 0 for the most frequent level, ties by name.

    Levels are counted with partial sums, cut into ranges of that order, and numbered
    from the sizes of the ranges: no task holds all levels of a column.
    """
    with storage(df.sparkSession) as own:
        counted = level_counts(df, columns).withColumns({"_fewer": -F.col("n"), "_one": F.lit(1)})
        placed = sums_before(counted, ["column", "_fewer", "level"], "_one", "_place")
        first = placed.groupBy("column").agg(F.min("_place").alias("_first"))
        idx = (F.col("_place") - F.col("_first")).cast("int").alias("idx")
        return own.result(join_on(placed, first, ["column"]).select("column", "level", "n", idx), "levels")


def _labels(df: DataFrame, columns: Sequence[str], max_levels: int) -> dict[str, list[str]]:
    """Ranked levels for MLlib, which holds them on the driver: at most ``max_levels`` a column.

    Tasks pass on their own first levels only, so the window is as short as the result.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), "level")
    ranked = level_counts(df, columns).withColumn("place", F.row_number().over(order))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(ranked.filter(F.col("place") <= max_levels + 1).collect(), key=lambda r: r.place):
        found[row["column"]].append(row.level)
    wide = [c for c, levels in found.items() if len(levels) > max_levels]
    if wide:
        raise ValueError(
            f"more than {max_levels} levels in {', '.join(wide)}: "
            "one-hot vectors that wide need another encoding, or a larger max_levels"
        )
    return found


def long_features(
    df: DataFrame, keys: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """``keys, position, value``: the entries of the feature vector that are not zero.

    Positions are those of ``fit_encoder``: numeric columns first, then a block per
    category column. Levels stay in a table, so a column may have any number of them;
    neither the driver nor a row holds them. A NULL level has no entry. ``df`` is read
    three times: hand in a stored frame.
    """
    index = category_index(df, categorical)
    sizes = index.groupBy("column").agg(F.count("*").alias("size"))
    place = F.array_position(F.array(*map(F.lit, categorical)), F.col("column"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    offset = len(numeric) + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    offsets = sizes.select("column", offset.alias("offset"))  # a row per column
    positions = join_on(index, offsets, ["column"]).select(
        F.col("column").alias("_column"), F.col("level").alias("_level"), (F.col("offset") + F.col("idx")).cast("int").alias("position")
    )
    stacked = df.select(*keys, F.posexplode(F.array(*[F.col(c).cast("double") for c in numeric])).alias("position", "value"))
    levels = df.select(*keys, F.posexplode(F.array(*categorical)).alias("_number", "_level"))
    levels = levels.withColumn("_column", name_at(categorical, F.col("_number"))).filter(F.col("_level").isNotNull())
    ones = levels.join(positions, ["_column", "_level"]).select(*keys, "position", F.lit(1.0).alias("value"))
    return stacked.filter(F.col("value") != 0).unionByName(ones)


def fit_indexers(
    df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS
) -> PipelineModel:
    """String to index by frequency, one indexer per column, all from one job.

    A level not seen here gets the extra index. The labels come from a hash
    aggregation with map-side counts; a column with more than ``max_levels`` is
    refused.
    """
    labels = _labels(df, columns, max_levels)
    return PipelineModel(
        [
            StringIndexerModel.from_labels(
                labels[c],
                inputCol=c,
                outputCol=index_suffix(c),
                handleInvalid="keep",
            )
            for c in columns
        ]
    )


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    """The extra "unseen" slot is the dropped last one, so it encodes to all zeros."""
    return OneHotEncoder(
        inputCols=[index_suffix(c) for c in columns],
        outputCols=[one_hot_suffix(c) for c in columns],
        dropLast=True,
    )


def assemble(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def fit_encoder(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    max_levels: int = MAX_LEVELS,
) -> PipelineModel:
    """Index, encode and assemble as one fitted model, at the price of one job.

    The encoder takes its sizes from the indexer's column metadata, so the only
    pass over the data is the level count.
    """
    indexers = fit_indexers(df, categorical, max_levels)
    encoder = one_hot(categorical).fit(indexers.transform(df.select(*categorical)))
    assembler = assemble([*numeric, *[one_hot_suffix(c) for c in categorical]])
    return PipelineModel([*indexers.stages, encoder, assembler])


def save_encoder(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_encoder(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_index_map(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Vector position -> feature name, source column and category level."""
    indexers = {s.getOutputCol(): s for s in model.stages if isinstance(s, StringIndexerModel)}
    encoder = next(s for s in model.stages if isinstance(s, OneHotEncoderModel))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    encoded = {
        out: (indexers[index].getInputCol(), indexers[index].labels[: size - 1])
        for index, out, size in zip(
            encoder.getInputCols(), encoder.getOutputCols(), encoder.categorySizes, strict=True
        )
    }
    named: list[tuple[str, str, str | None]] = []
    for name in assembler.getInputCols():
        if name in encoded:
            column, levels = encoded[name]
            named += [(f"{name}_{i}", column, level) for i, level in enumerate(levels)]
        else:
            named.append((name, name, None))
    return rows_to_frame(spark, [(i, *row) for i, row in enumerate(named)], FEATURE_INDEX)
