"""The registry of news sources: checks, loading, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gladwire import fixed, schemas
from gladwire.functions.text import non_empty
from gladwire.session import new_folder


class RegistryError(ValueError):
    """A registry with bad rows. ``report`` is the frame of all problems."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def registry_problems(raw: DataFrame, record: str = "record", order: str = "ord") -> DataFrame:
    """(ord, problem) for every broken rule in JSON registry records.

    A required field must be present, be it null. Types are those of the JSON
    values, so "0.5" is no number; true and false pass as numbers.
    """
    keys = F.json_object_keys(record)
    value = F.try_parse_json(record)

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))

    def text(field: str) -> Column:
        return F.try_variant_get(value, f"$.{field}", "string")

    def given(field: str) -> Column:
        return F.array_contains(keys, field) & (F.coalesce(kind(field), F.lit("VOID")) != "VOID")

    missing = F.filter(
        F.array(*[F.lit(f) for f in fixed.REQUIRED_SOURCE_FIELDS]), lambda f: ~F.array_contains(keys, f)
    )
    is_number = kind("threshold").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    number = F.coalesce(
        F.try_variant_get(value, "$.threshold", "double"),
        F.try_variant_get(value, "$.threshold", "boolean").cast("double"),
    )
    adapter_ok = (kind("adapter") == "STRING") & text("adapter").isin(*fixed.KNOWN_ADAPTERS)
    place = F.concat(
        F.lit("Source["), F.col(order).cast("string"), F.lit("] "), F.coalesce(text("name"), F.lit("?"))
    )
    rules = F.array(
        F.when(F.size(missing) > 0, F.concat(place, F.lit(": missing "), F.array_join(missing, ", "))),
        F.when(given("threshold") & ~is_number, F.concat(place, F.lit(": threshold is not a number"))),
        F.when(
            given("threshold") & is_number & ~number.between(0.0, 1.0),
            F.concat(place, F.lit(": threshold is not between 0 and 1")),
        ),
        F.when(
            given("active") & (kind("active") != "BOOLEAN"),
            F.concat(place, F.lit(": active is not true or false")),
        ),
        F.when(given("adapter") & ~adapter_ok, F.concat(place, F.lit(": adapter is unknown"))),
    )
    no_record = F.array(
        F.concat(F.lit("Source["), F.col(order).cast("string"), F.lit("] is not a record"))
    )
    problems = F.when(keys.isNull(), no_record).otherwise(F.array_compact(rules))
    return raw.select(order, F.explode_outer(problems).alias("problem")).filter(
        F.col("problem").isNotNull()
    )


def validate_registry(raw: DataFrame, record: str = "record", order: str = "ord") -> DataFrame:
    """The records unchanged; raises ``RegistryError`` with the table of all problems.

    The problems are written to the shared folder, one row each; the error gives
    their number and place, and ``report`` reads them.
    """
    problems = registry_problems(raw, record, order)
    path = new_folder(raw.sparkSession, "registry-problems")
    problems.write.parquet(path)
    report = raw.sparkSession.read.schema(problems.schema).parquet(path)
    count = report.count()
    if count:
        raise RegistryError(f"The source registry is not valid: {count} problems, listed in {path}", report)
    return raw


def parse_registry(raw: DataFrame, record: str = "record", order: str = "ord") -> DataFrame:
    """JSON records as registry rows, with ``ord`` as ``source_ord``."""
    parsed = F.from_json(record, schemas.REGISTRY)
    return raw.select(F.col(order).alias("source_ord"), parsed.alias("r")).select("source_ord", "r.*")


def active_sources(registry: DataFrame) -> DataFrame:
    """Rows flagged active that have a feed address; without an ``active`` column all count."""
    with_feed = registry.filter(F.col("rss_url").isNotNull())
    return with_feed.filter(F.col("active")) if "active" in registry.columns else with_feed


def with_feed_address(registry: DataFrame) -> DataFrame:
    """Rows with a feed address that is not empty."""
    return registry.filter(non_empty("rss_url").isNotNull())


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Active sources of a JSON registry file with a ``sources`` array; checked first.

    A missing file or key gives no rows.
    """
    names = spark.createDataFrame([], schemas.REGISTRY).select(F.lit(0).alias("source_ord"), "*")
    try:
        whole = spark.read.text(path, wholetext=True)
    except Exception as problem:  # noqa: BLE001 - Spark has no narrower class for a missing path
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return names
    items = F.from_json(F.get_json_object("value", "$.sources"), "array<string>")
    raw = whole.select(F.posexplode(items).alias("ord", "record"))
    validate_registry(raw)
    present = raw.filter(F.array_contains(F.json_object_keys("record"), "active"))
    registry = parse_registry(raw)
    if present.isEmpty():
        registry = registry.drop("active")
    return active_sources(registry)


def source_key(registry: DataFrame) -> Column:
    """The key of a source; its name where it has none."""
    return F.coalesce(non_empty("source_id"), non_empty("name")) if "name" in registry.columns else F.col("source_id")


def seed_rows(registry: DataFrame) -> DataFrame:
    """Registry rows as rows of the sources table; an absent flag counts as active."""
    active = F.coalesce(F.col("active"), F.lit(True)) if "active" in registry.columns else F.lit(True)
    return registry.filter(non_empty("source_id").isNotNull()).select(
        F.col("source_ord").alias("seq"), "source_id", F.coalesce("name", F.lit("")).alias("name"),
        "domain", "rss_url", "url", active.alias("active"), "category",
    )


def adapter_of(adapter: Column) -> Column:
    """Adapter name in lower case; null, empty and NaN become ``rss``."""
    given = F.lower(non_empty(adapter))
    return F.when(given.isNull() | (given == "nan"), fixed.DEFAULT_ADAPTER).otherwise(given)
