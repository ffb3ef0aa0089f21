"""Table and column catalogs: lookup, expansion to physical columns, upkeep."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.constants import FULL, HASH_EXCLUDED
from layerloom.functions.hashing import hashed_names
from layerloom.functions.types import BOOLEAN_NAMES, element_type
from layerloom.operators.keyed import latest_per_key, skew_safe_join, upsert

TABLE_CATALOG_SCHEMA = (
    "table_name string, config_name string, primary_key_cols string, "
    "has_timestamps boolean, notes string, is_active boolean"
)
COLUMN_CATALOG_SCHEMA = (
    "table_name string, column_name string, data_type string, progress_type string, "
    "is_mandatory boolean, width int, scale int, extent int, progress_order int"
)


@dataclass(frozen=True)
class TargetColumn:
    """One physical column of a typed layer; ``element`` is 0 for a scalar."""

    source: str
    element: int
    name: str
    sql_type: str
    mandatory: bool = False


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    config_name: str | None
    primary_keys: tuple[str, ...]
    has_timestamps: bool
    description: str
    columns: tuple[TargetColumn, ...]

    @property
    def physical_name(self) -> str:
        return self.config_name or self.table_name

    def hash_columns(self, exclude: frozenset[str] = HASH_EXCLUDED) -> tuple[str, ...]:
        """Exclusions name the catalog column, so they cover all its elements."""
        content = set(hashed_names((c.source for c in self.columns), exclude))
        return tuple(c.name for c in self.columns if c.source in content)


def lookup_key() -> Column:
    return F.coalesce(F.col("config_name"), F.col("table_name"))


def primary_keys(text: Column) -> Column:
    """``"a, b"`` to ``[a, b]``; no text gives an empty list."""
    parts = F.transform(F.split(text, ","), lambda part: F.trim(part))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(parts)


def active(tables: DataFrame) -> DataFrame:
    """Active catalog rows with their lookup key and parsed primary key."""
    return tables.filter(F.col("is_active")).select(
        lookup_key().alias("lookup_name"),
        "table_name",
        "config_name",
        primary_keys(F.col("primary_key_cols")).alias("primary_keys"),
        F.coalesce("has_timestamps", F.lit(False)).alias("has_timestamps"),
        F.lit(False).alias("force_full"),
        F.coalesce("notes", F.lit("")).alias("description"),
    )


def catalog_lookup(tables: DataFrame) -> DataFrame:
    """One active entry per lookup key; the table name breaks ties."""
    order = [F.asc("table_name"), F.asc_nulls_first("config_name"), F.asc("description")]
    return latest_per_key(active(tables), ["lookup_name"], order)


def active_tables(tables: DataFrame) -> DataFrame:
    """Names of the active tables, in table name order."""
    ordered = tables.filter(F.col("is_active")).orderBy("table_name", lookup_key())
    return ordered.select(lookup_key().alias("lookup_name"))


def normal_type(declared: Column) -> Column:
    """Declared scalar type; the spellings of a boolean fold to BOOLEAN."""
    kept = F.coalesce(declared, F.lit("TEXT"))
    return F.when(F.upper(kept).isin(*BOOLEAN_NAMES), F.lit("BOOLEAN")).otherwise(kept)


def expand(columns: DataFrame) -> DataFrame:
    """One row per physical column: an array column becomes ``name_1 .. name_n``."""
    extent = F.coalesce(F.col("extent"), F.lit(0))
    elements = F.when(extent > 0, F.sequence(F.lit(1), F.greatest(extent, F.lit(1)))).otherwise(F.array(F.lit(0)))
    rows = columns.withColumn("extent", extent).withColumn("element", F.explode(elements))
    packed = F.col("element") > 0
    return rows.select(
        "table_name",
        "progress_order",
        F.col("column_name").alias("source_column"),
        "element",
        F.when(packed, F.concat_ws("_", "column_name", F.col("element").cast("string")))
        .otherwise(F.col("column_name"))
        .alias("target_column"),
        F.when(packed, element_type(F.col("progress_type"), F.col("extent"), F.col("width"), F.col("scale")))
        .otherwise(normal_type(F.col("data_type")))
        .alias("target_type"),
        F.coalesce("is_mandatory", F.lit(False)).alias("is_mandatory"),
    )


def widths(columns: DataFrame) -> DataFrame:
    """Per table: declared, array, expanded and mandatory column counts."""
    extent = F.coalesce(F.col("extent"), F.lit(0))
    return columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(extent > 0).alias("extent_column_count"),
        F.sum(F.when(extent > 0, extent).otherwise(1)).cast("bigint").alias("expanded_column_count"),
        F.count_if(F.coalesce("is_mandatory", F.lit(False))).alias("mandatory_column_count"),
    )


# --- fixed values: what a column entry must have, and the messages if not ----
REQUIRED_FIELDS = ("column_name", "data_type", "progress_type")
NO_COLUMNS = "Empty columns list"
MISSING_FIELD = "missing field '{}'"
# --- end of fixed values -----------------------------------------------------


def validate(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Catalog defects: tables without columns and columns without a required field."""
    empty = tables.join(columns.select("table_name"), "table_name", "left_anti").select(
        "table_name",
        F.lit(None).cast("int").alias("progress_order"),
        F.lit(NO_COLUMNS).alias("error"),
    )
    checks = F.array(
        *[F.when(F.col(name).isNull(), F.lit(MISSING_FIELD.format(name))) for name in REQUIRED_FIELDS]
    )
    found = columns.select("table_name", "progress_order", F.explode(F.array_compact(checks)).alias("error"))
    return empty.unionByName(found)


def load_spec(tables: DataFrame, columns: DataFrame, table: str, config: str | None = None) -> TableSpec | None:
    """The catalog entry of one table, brought to the driver to build its expressions.

    What is collected is one table's column list, bounded by the table's width.
    """
    entry = catalog_lookup(tables).filter(F.col("lookup_name") == (config or table)).first()
    if entry is None:
        return None
    rows = expand(columns.filter(F.col("table_name") == entry["table_name"])).orderBy("progress_order", "element")
    return TableSpec(
        table_name=entry["table_name"],
        config_name=entry["config_name"],
        primary_keys=tuple(entry["primary_keys"]),
        has_timestamps=entry["has_timestamps"],
        description=entry["description"],
        columns=tuple(
            TargetColumn(r["source_column"], r["element"], r["target_column"], r["target_type"], r["is_mandatory"])
            for r in rows.collect()
        ),
    )


def enrich(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Landed files with their catalog entry; unknown tables get empty defaults.

    The catalog side is small in practice and Catalyst broadcasts it then; a
    large one is joined by shuffle.
    """
    entries = catalog_lookup(tables).select(
        "lookup_name",
        F.col("primary_keys").alias("_pk"),
        F.col("has_timestamps").alias("_ts"),
        F.col("force_full").alias("_ff"),
        F.col("description").alias("_ds"),
    )
    keyed = files.withColumn("lookup_name", F.coalesce("config_name", "table_name"))
    joined = skew_safe_join(keyed, entries.withColumn("_known", F.lit(True)), ["lookup_name"], "left")
    force = F.coalesce(F.col("_ff"), F.lit(False))
    return joined.select(
        *[c for c in files.columns if c != "load_mode"],
        F.when(force, F.lit(FULL)).otherwise(F.col("load_mode")).alias("load_mode"),
        F.coalesce("_pk", F.array().cast("array<string>")).alias("primary_keys"),
        F.coalesce("_ts", F.lit(False)).alias("has_timestamps"),
        force.alias("force_full"),
        F.coalesce("_ds", F.lit("")).alias("table_description"),
        F.coalesce("_known", F.lit(False)).alias("in_catalog"),
    )


CATALOG_KEYS = ("table_name", "column_name")
CATALOG_UPDATED = ("data_type", "is_mandatory", "width", "scale")
# Where a column stands among all dumps: time and name of the dump, place in its list.
DUMP_ORDER = ("_dump_written", "_dump_file", "_dump_position")


def catalog_upsert(columns: DataFrame, dump: DataFrame) -> DataFrame:
    """The column catalog after a metadata dump.

    A match changes type, mandatory flag, width and scale only; a new column
    also gets its order, while source type and extent stay unset. Of a column
    that the dump repeats, the last one counts (``DUMP_ORDER``); without an
    order, the one with the largest values.
    """
    filled = dump.withColumns(
        {
            "is_mandatory": F.coalesce("is_mandatory", F.lit(False)),
            "progress_order": F.coalesce("progress_order", F.lit(0)),
        }
    )
    order = [c for c in DUMP_ORDER if c in dump.columns]
    rest = [F.desc(c) for c in (*order, "progress_order", *CATALOG_UPDATED)]
    filled = latest_per_key(filled, CATALOG_KEYS, rest).drop(*order)
    return upsert(columns, filled, CATALOG_KEYS, CATALOG_UPDATED, (*CATALOG_UPDATED, "progress_order"))
