"""Checks and shaping that follow from the target's configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.functions.patterns import default_pipeline, template_match
from docferry.operators.batch import READING_ORDER, number_sorted

# Fixed value: the pipeline name that switches the default pipeline off.
NO_PIPELINE = "_none"


@dataclass(frozen=True)
class TargetOptions:
    """What one load says about its target: ingest pipeline and template, by name and body."""

    pipeline_name: str | None = None
    pipeline_body: str | None = None
    template_name: str | None = None
    template_body: str | None = None
    template_overwrite: bool | None = None

    def __post_init__(self):
        if self.template_body is None:
            if self.template_name is not None:
                raise ValueError("a template name needs a template")
            if self.template_overwrite is not None:
                raise ValueError("template overwrite needs a template")
        elif not self.template_name:
            raise ValueError("a template needs a name")
        if self.pipeline_body is None:
            if self.pipeline_name is not None and self.pipeline_name != NO_PIPELINE:
                raise ValueError(f"a pipeline name needs a pipeline, unless it is {NO_PIPELINE}")
            if self.pipeline_name == NO_PIPELINE and self.template_body is not None:
                raise ValueError(f"{NO_PIPELINE} cannot be combined with a template")
        elif not self.pipeline_name:
            raise ValueError("a pipeline needs a name")
        elif self.pipeline_name == NO_PIPELINE:
            raise ValueError(f"{NO_PIPELINE} is no name for a pipeline of one's own")

    @property
    def request_pipeline(self) -> str | None:
        """Pipeline named in each bulk request; a template takes its place."""
        return None if self.template_body is not None else self.pipeline_name

    @property
    def given(self) -> bool:
        return any(v is not None for v in vars(self).values())


def check_targets(targets: DataFrame, known_pipelines: DataFrame) -> DataFrame:
    """Preflight of many targets at once.

    ``targets``: ``index``, ``template_name``, ``template_body``, ``pipeline_name`` and
    ``has_pipeline`` (the load brings the pipeline itself). ``known_pipelines``: ``name``
    of the pipelines that exist. Adds ``template_pipeline``, ``request_pipeline``,
    ``patterns_match`` and ``status``. A plain equi-join: Spark broadcasts the small side
    only below its own size threshold, and splits skewed keys otherwise. Targets that name
    no pipeline get keys of their own that match nothing, so they do not meet in one task.
    """
    known = known_pipelines.select(F.col("name").alias("_known")).distinct()
    named = targets.withColumn("template_pipeline", default_pipeline(F.col("template_body")))
    spread = F.concat(F.lit("\0"), F.xxhash64("index").cast("string"))
    joined = named.join(known, F.coalesce("template_pipeline", spread) == F.col("_known"), "left")
    has_template = F.col("template_body").isNotNull()
    own = F.coalesce(F.col("has_pipeline"), F.lit(False))
    reserved = F.coalesce(F.col("pipeline_name") == NO_PIPELINE, F.lit(False))
    status = (
        F.when(own & F.coalesce(F.col("pipeline_name") == "", F.lit(True)), "pipeline without name")
        .when(own & reserved, "reserved pipeline name")
        .when(~own & F.col("pipeline_name").isNotNull() & ~reserved, "pipeline name without pipeline")
        .when(~own & reserved & has_template, "reserved name with template")
        .when(has_template & own & F.col("template_pipeline").isNull(), "template names no pipeline")
        .when(has_template & own & (F.col("template_pipeline") != F.col("pipeline_name")), "template names another pipeline")
        .when(
            has_template & ~own & F.col("template_pipeline").isNotNull() & F.col("_known").isNull(),
            "template pipeline is missing",
        )
        .otherwise("ok")
    )
    return (
        joined.withColumn("status", status)
        .withColumn("request_pipeline", F.when(~has_template & (own | reserved), F.col("pipeline_name")))
        .withColumn(
            "patterns_match", F.when(has_template, template_match(F.col("template_body"), F.col("index"))["matched"])
        )
        .drop("_known")
    )


def missing_pipelines(templates: DataFrame, known_pipelines: DataFrame) -> DataFrame:
    """Templates whose default pipeline does not exist."""
    known = known_pipelines.select(F.col("name").alias("template_pipeline"))
    named = templates.withColumn("template_pipeline", default_pipeline(F.col("body")))
    return named.where(F.col("template_pipeline").isNotNull()).join(known, "template_pipeline", "left_anti")


def apply_processors(df: DataFrame, processors: list[dict]) -> DataFrame:
    """Apply ``set``, ``split`` and ``convert`` (to boolean) steps to columns, in order.

    A missing column fails unless the step says ``ignore_missing``.
    """
    for step in processors:
        ((name, spec),) = step.items()
        field = spec["field"]
        if name == "set":
            df = df.withColumn(field, F.lit(spec["value"]))
            continue
        if field not in df.columns:
            if spec.get("ignore_missing"):
                continue
            raise ValueError(f"field is missing: {field}")
        column = F.col(f"`{field}`")
        if name == "split":
            df = df.withColumn(field, F.split(column, spec["separator"]))
        elif name == "convert" and spec["type"] == "boolean":
            low = F.lower(column.cast("string"))
            value = F.when(low == "true", True).when(low == "false", False)
            failure = F.raise_error(F.concat(F.lit(f"{field} is no boolean: "), column.cast("string")))
            df = df.withColumn(field, F.when(column.isNull() | value.isNotNull(), value).otherwise(failure))
        else:
            raise ValueError(f"unsupported step: {name}")
    return df


# Mapping type -> Spark type.
MAPPING_TYPES = {"integer": "int", "float": "float", "boolean": "boolean", "keyword": "string", "text": "string"}


def apply_mapping(df: DataFrame, properties: dict[str, dict]) -> DataFrame:
    """Give string columns the types a mapping declares; other columns stay as they are.

    Text that does not fit its type becomes null.
    """
    typed = {}
    for field, spec in properties.items():
        if field not in df.columns:
            continue
        column = F.col(f"`{field}`")
        if spec["type"] != "date" and spec["type"] not in MAPPING_TYPES:
            raise ValueError(f"mapping of {field}: type {spec['type']} is not one of date, {', '.join(MAPPING_TYPES)}")
        if spec["type"] == "date":
            pattern = spec.get("format", "yyyy-MM-dd")
            typed[field] = F.try_to_timestamp(column, F.lit(pattern)).cast("date")
        else:
            typed[field] = column.try_cast(MAPPING_TYPES[spec["type"]])
    return df.withColumns(typed)


def sort_for_index(df: DataFrame, fields: list[str], orders: list[str], unique: list[str] | None = None) -> DataFrame:
    """Bring rows into index sort order.

    A global sort by range partitions, so each shard gets its documents in order however
    many shards there are. Rows that share a value, copies of one document even, are spread
    over several partitions by the ``unique`` columns, which come last: by default the
    reading order where the rows have one, else a hash of the row.
    """
    keys = [F.col(f"`{f}`").desc() if o == "desc" else F.col(f"`{f}`").asc() for f, o in zip(fields, orders)]
    if unique is None and set(READING_ORDER) <= set(df.columns):
        unique = list(READING_ORDER)
    if unique is None:
        keys.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    else:
        keys += [F.col(f"`{c}`") for c in unique]
    return df.orderBy(*keys)


def shard_of(id: Column, shards: int) -> Column:
    """The shard a document's identifier routes it to: a hash of the text, by the number of shards."""
    if shards < 1:
        raise ValueError("an index has at least 1 shard")
    digits = F.substring(F.md5(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % shards).cast("int")


def sort_for_shards(
    df: DataFrame, id_col: str, shards: int, fields: list[str], orders: list[str], unique: list[str] | None = None
) -> DataFrame:
    """Add ``shard`` and ``place``, the row's position from 0 in its shard's index sort order.

    Shards are few and large, so no task takes a whole one: rows are range-sorted by shard
    and keys, numbered across the ranges, and a shard's first number is taken off.
    """
    routed = df.withColumn("shard", shard_of(F.col(f"`{id_col}`"), shards))
    numbered = number_sorted(sort_for_index(routed, ["shard", *fields], ["asc", *orders], unique or [id_col]))
    counts = routed.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    placed = numbered.join(F.broadcast(starts), "shard").withColumn("place", F.col("row_index") - F.col("_first"))
    return placed.select(*df.columns, "shard", "place")
