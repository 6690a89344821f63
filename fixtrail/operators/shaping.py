"""Projection, flattening and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode, snake_name

# Envelope, version and version-2 sub-score columns of a flattened feed.
FEED_EXTRAS = (
    "CVE_Items",
    "CVE_data_format",
    "CVE_data_numberOfCVEs",
    "CVE_data_timestamp",
    "CVE_data_type",
    "CVE_data_version",
    "configurations.CVE_data_version",
    "cve.CVE_data_meta.ASSIGNER",
    "cve.data_format",
    "cve.data_type",
    "cve.data_version",
    "impact.baseMetricV2.cvssV2.version",
    "impact.baseMetricV2.exploitabilityScore",
    "impact.baseMetricV2.impactScore",
    "impact.baseMetricV3.cvssV3.version",
    "index",
)


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs become dotted leaf columns; arrays stay as they are."""
    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                found.append(F.col(quoted).alias(".".join(here)))
        return found

    return df.select(*leaves(df.schema, ()))


def snake_columns(df: DataFrame) -> DataFrame:
    """S2 on all column names."""
    return df.toDF(*[snake_name(name) for name in df.columns])


def drop_columns(df: DataFrame, names: Sequence[str] = FEED_EXTRAS) -> DataFrame:
    """S3: drop by exact name, dotted names included; absent names are ignored."""
    unwanted = set(names)
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name not in unwanted])


def align_schema(df: DataFrame, schema: T.StructType | str, missing: str | None = "") -> DataFrame:
    """The schema's columns in its order and types; an absent text column is filled with ``missing``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name in present:
            value = F.col(f"`{field.name}`").cast(field.dataType)
        else:
            fill = missing if isinstance(field.dataType, T.StringType) else None
            value = F.lit(fill).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, dotted names included."""
    return df.toDF(*[names.get(name, name) for name in df.columns])


def drop_empty_refs(df: DataFrame, refs: str) -> DataFrame:
    """Keep records whose reference array is not empty; NULL arrays stay."""
    values = F.col(f"`{refs}`")
    return df.where(values.isNull() | (F.size(values) != 0))


def merge_frames(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; absent columns are NULL."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def decode_markers(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Markers of a missing value → NULL, the rest typed; text that is no ``to`` becomes NULL."""
    return df.withColumns({name: decode(F.col(name)).try_cast(to) for name in columns})


def to_text(df: DataFrame, columns: Sequence[str], missing: str = "None") -> DataFrame:
    """S8 reversed: text columns with a marker for NULL."""
    return df.withColumns({name: F.coalesce(F.col(name).cast("string"), F.lit(missing)) for name in columns})


def _columns_of(df: DataFrame, kind: type) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kind)]


def replace_all_strings(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Replace single characters (an empty value removes) in every string column."""
    # translate() drops characters without a partner, so removals go last.
    kept = {old: new for old, new in mapping.items() if new}
    removed = [old for old, new in mapping.items() if not new]
    source, target = "".join([*kept, *removed]), "".join(kept.values())
    return df.withColumns({name: F.translate(name, source, target) for name in _columns_of(df, T.StringType)})


def fill_null(df: DataFrame, counts: Sequence[str], to: str = "bigint") -> DataFrame:
    """NULL → 0 in number columns, the named counts typed as whole numbers."""
    return df.fillna(0).withColumns({name: F.col(name).cast(to) for name in counts})


def round_all(df: DataFrame, digits: int) -> DataFrame:
    """Round every floating-point column."""
    names = _columns_of(df, T.DoubleType) + _columns_of(df, T.FloatType)
    return df.withColumns({name: F.round(name, digits) for name in names})


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the least by ``order``.

    An aggregate rather than a ranking window: every task keeps one row per key
    before the shuffle, so a frequent key costs no more than a rare one.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(name) if name in keys else F.col(f"_first.`{name}`").alias(name) for name in df.columns]
    )
