"""Source configurations: scan, validation, upsert, page frontier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from trendloom.operators.ordering import keep_last

FRONTIER_CHUNK = 65536

REQUIRED_BY_STRATEGY = {
    "json_script": ("script_type", "schema_type", "array_key", "mapping"),
    "html_dom": ("container_tag", "headline_tag", "summary_tag"),
}
REQUIRED_MAPPING_KEYS = ("headline", "link", "summary")


def scan_configs(stored: DataFrame) -> DataFrame:
    """Stored configurations with ``mapping`` decoded from its JSON text."""
    if isinstance(stored.schema["mapping"].dataType, T.MapType):
        return stored
    return stored.withColumn("mapping", F.from_json("mapping", "map<string,string>"))


def sparse_fields(stored: DataFrame) -> DataFrame:
    """One ``field -> text`` map per site that holds the non-null fields only."""
    entries = []
    for field in stored.schema.fields:
        if field.name == "site_name":
            continue
        value = F.to_json(field.name) if isinstance(field.dataType, T.MapType) else F.col(field.name)
        entries += [F.lit(field.name), value.cast("string")]
    return stored.select(
        "site_name", F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull()).alias("fields")
    )


def with_reject_reason(configs: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the first missing required field, or null for a usable configuration."""
    missing = F.lit(None).cast("string")
    checks = [(F.lit(True), F.col(name).isNull(), name) for name in ("url_template", "pages", "strategy")]
    for strategy, names in REQUIRED_BY_STRATEGY.items():
        applies = F.col("strategy") == strategy
        checks += [(applies, F.col(name).isNull(), name) for name in names]
    applies = F.col("strategy") == "json_script"
    for key in REQUIRED_MAPPING_KEYS:
        checks.append((applies, F.element_at("mapping", key).isNull(), f"mapping.{key}"))
    for applies, absent, name in reversed(checks):
        missing = F.when(applies & absent, F.lit(f"missing {name}")).otherwise(missing)
    return configs.withColumn("reject_reason", missing)


def upsert_configs(stored: DataFrame, incoming: DataFrame, seq: str = "seq") -> DataFrame:
    """Replace whole rows by ``site_name``; the columns are the union of both sides.

    ``seq`` orders the incoming rows, the last one per site wins. A field an incoming row lacks becomes
    null. Map fields are stored as JSON text.
    """
    for field in incoming.schema.fields:
        if isinstance(field.dataType, T.MapType):
            incoming = incoming.withColumn(field.name, F.to_json(field.name))
    old = stored.withColumn("_order", F.struct(F.lit(0).alias("b"), F.lit(0).cast("long").alias("s")))
    new = incoming.withColumn(
        "_order", F.struct(F.lit(1).alias("b"), F.col(seq).cast("long").alias("s"))
    ).drop(seq)
    merged = old.unionByName(new, allowMissingColumns=True)
    return keep_last(merged, ["site_name"], ["_order"]).drop("_order")


def url_frontier(configs: DataFrame) -> DataFrame:
    """One row per page to read: ``site, page_num, url``.

    Page numbers are generated in bounded chunks that are spread over the tasks, so a site with very
    many pages does not become one huge array in one row.
    """
    chunks = configs.filter(F.col("pages") >= 1).select(
        F.col("site_name").alias("site"),
        "url_template",
        "pages",
        F.explode(F.sequence(F.lit(0), F.expr(f"int((pages - 1) div {FRONTIER_CHUNK})"))).alias("chunk"),
    )
    first = F.col("chunk") * FRONTIER_CHUNK + 1
    last = F.least(F.col("pages").cast("long"), (F.col("chunk").cast("long") + 1) * FRONTIER_CHUNK).cast("int")
    return (
        chunks.repartition("site", "chunk")
        .withColumn("page_num", F.explode(F.sequence(first, last)))
        .select(
            "site",
            "page_num",
            F.replace("url_template", F.lit("{}"), F.col("page_num").cast("string")).alias("url"),
        )
    )
