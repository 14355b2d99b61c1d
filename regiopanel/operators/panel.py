"""Panel integration: rename, N-way full outer merge on (code, year), profiles.

The N-way merge is a ``unionByName`` of all sources followed by ONE
``groupBy(keys)``: one shuffle for any number of sources, where a chain of
outer joins costs two exchanges per join. The forms are equal when each source
has unique keys; that is asserted inside the same job with ``raise_error``
(no extra pass), since a duplicate would multiply rows in a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored (pandas ``rename`` behaviour)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise with the missing names when ``df`` lacks any required column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def resolve_nulls(df: DataFrame, columns: Sequence[str], how: str, value: float = 0.0) -> DataFrame:
    """Nulls that an outer merge leaves, settled before a model sees them; the policy must be chosen.

    ``how='fill'`` puts ``value``; ``how='drop'`` keeps the rows that have every
    column. z-scores, k-means, PCA, the forest and the classifier take no nulls.
    """
    if how == "fill":
        return df.fillna(value, list(columns))
    if how == "drop":
        return df.dropna("any", subset=list(columns))
    raise ValueError("how is 'fill' or 'drop'")


def merge_panel(sources: Mapping[str, DataFrame], keys: Sequence[str] = ("code", "year"),
                check_unique: bool = True, numeric_as_double: bool = True) -> DataFrame:
    """Full outer merge of keyed sources into one wide frame, keys coalesced.

    Measure names must be distinct across sources (a clash raises instead of
    producing ``_x/_y`` suffixes). Null keys group together, like pandas merge.
    With ``numeric_as_double`` numeric measures become double, as pandas makes
    any integer column that the outer merge fills with missing values.
    """
    keys = list(keys)
    seen: dict[str, str] = {}
    for name, df in sources.items():
        require_columns(df, keys)
        for c in df.columns:
            if c in keys:
                continue
            if c in seen:
                raise ValueError(f"column {c!r} appears in sources {seen[c]!r} and {name!r}")
            seen[c] = name
    frames = []
    for i, (name, df) in enumerate(sources.items()):
        frames.append(df.withColumn("_src", F.lit(i)))
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    measures = [c for c in seen]
    aggs = [F.first(c, ignorenulls=True).alias(c) for c in measures]
    names = list(sources)
    if check_unique:
        aggs += [F.count_if(F.col("_src") == F.lit(i)).alias(f"_n{i}") for i in range(len(names))]
    merged = stacked.groupBy(*keys).agg(*aggs)
    if check_unique:
        guard = F.coalesce(*[
            F.when(F.col(f"_n{i}") > 1, F.raise_error(F.lit(f"panel source {n!r} has duplicate keys")))
            for i, n in enumerate(names)
        ], F.lit(True))
        merged = merged.filter(guard).drop(*[f"_n{i}" for i in range(len(names))])
    out_cols = []
    for c in measures:
        dtype = dict(stacked.dtypes)[c]
        is_num = dtype in ("tinyint", "smallint", "int", "bigint", "float") or dtype.startswith("decimal")
        out_cols.append(F.col(c).cast("double").alias(c) if numeric_as_double and is_num else F.col(c))
    return merged.select(*keys, *out_cols)


def source_profile(sources: Mapping[str, DataFrame], code: str = "code", year: str = "year") -> DataFrame:
    """Rows, distinct codes, distinct years and null-key rows per source.

    The sources' key columns are tagged and unioned, then profiled by ONE
    grouped aggregation (one distinct-aggregation plan for any number of sources).
    """
    keys = None
    for name, df in sources.items():
        part = df.select(F.lit(name).alias("source"), F.col(code).alias("_code"), F.col(year).alias("_year"))
        keys = part if keys is None else keys.unionByName(part)
    return keys.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("_code").alias("n_codes"),
        F.count_distinct("_year").alias("n_years"),
        F.count_if(F.col("_code").isNull() | F.col("_year").isNull()).alias("n_null_keys"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Schema plus non-null count per column, long form, from one aggregation pass."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    pieces = ", ".join(
        f"'{f.name}', {i + 1}, '{f.dataType.simpleString()}', _c{i}" for i, f in enumerate(fields))
    return counts.select(
        F.expr(f"stack({len(fields)}, {pieces}) AS (column_name, position, data_type, non_null)"),
        F.col("_rows").alias("n_rows"),
    ).select("column_name", F.col("position").cast("int").alias("position"), "data_type",
             "non_null", "n_rows")
