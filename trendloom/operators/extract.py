"""Article records from captured pages.

Pages carry ``site, page_num, html``. Every extraction adds ``pos``, the place of the record in its
page, so that arrival order survives the shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from trendloom import schemas
from trendloom.functions.dom import Element, parse_page
from trendloom.session import ensure_checkpoint_dir

# Fixed value: the date mark every extracted record carries.
DATE_MARK = "Captured"

# A comment hides the scripts inside it, so comments are matched too and dropped afterwards.
_SCRIPT = r"(?is)(<!--.*?-->|<script\b[^>]*>.*?</script\s*>)"
_SCRIPT_BODY = r"(?is)^<script\b[^>]*>(.*)</script\s*>$"
_SCRIPT_TYPE = r"""(?is)^<script\b[^>]*?\stype\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

_RECORD_FIELDS = schemas.RECORDS.fieldNames()
_DOM_FIELDS = (
    "container_tag", "container_class", "headline_tag", "anchor_position", "summary_tag",
)


def arrival_seq() -> Column:
    """Page number and place in the page as one BIGINT, unique within a site."""
    return (F.shiftleft(F.col("page_num").cast("long"), 31) + F.col("pos")).alias("ingest_seq")


def _member(key: Column) -> Column:
    quote = F.when(F.contains(key, F.lit("'")), F.lit('"')).otherwise(F.lit("'"))
    return F.concat(F.lit("$["), quote, key, quote, F.lit("]"))


def _is_object(element: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(element), F.lit("OBJECT<")), F.lit(False))


def json_script_records(pages: DataFrame, configs: DataFrame) -> DataFrame:
    """Records from JSON in ``<script type=T>`` blocks, one job for all sites.

    Only a top-level object whose ``@type`` equals ``schema_type`` counts. Elements of ``array_key`` are
    read up to the first one that is not an object.
    """
    wanted = configs.filter(F.col("strategy") == "json_script").select(
        F.col("site_name").alias("site"), "script_type", "schema_type", "array_key", "mapping"
    )
    scripts = F.filter(
        F.regexp_extract_all("html", F.lit(_SCRIPT), F.lit(1)),
        lambda s: F.startswith(s, F.lit("<s")) | F.startswith(s, F.lit("<S")),
    )

    def script_type(script: Column) -> Column:
        return F.concat(*[F.regexp_extract(script, _SCRIPT_TYPE, group) for group in (1, 2, 3)])

    def elements(script: Column) -> Column:
        data = F.try_parse_json(F.regexp_extract(script, _SCRIPT_BODY, 1))
        of_type = F.try_variant_get(data, "$['@type']", "string") == F.col("schema_type")
        listed = F.try_variant_get(data, _member(F.col("array_key")), "array<variant>")
        return F.when(_is_object(data) & of_type, listed)

    def leading_objects(listed: Column) -> Column:
        broken = F.array_position(F.transform(listed, lambda e: _is_object(e)), F.lit(False)).cast("int")
        size = F.when(broken > 0, broken - 1).otherwise(F.size(listed))
        return F.slice(listed, F.lit(1), size)

    typed = F.filter(scripts, lambda s: script_type(s) == F.col("script_type"))
    lists = F.filter(F.transform(typed, elements), lambda a: a.isNotNull())
    found = (
        pages.filter(F.contains("html", F.lit("</")))
        .join(wanted, "site")
        .select(
            "site",
            "page_num",
            "mapping",
            F.posexplode(F.flatten(F.transform(lists, leading_objects))).alias("pos", "element"),
        )
    )

    def field(name: str) -> Column:
        path = _member(F.element_at("mapping", name))
        return F.try_variant_get("element", path, "string").alias(name)

    return found.select(
        "site", "page_num", "pos", field("headline"), field("link"), field("summary"),
        F.lit(DATE_MARK).alias("date"),
    )


def _anchor(element: Element, position: str) -> Element | None:
    if position == "child":
        return element.first("a")
    if position == "parent":
        return element.enclosing("a")
    return element if element.name == "a" else None


def _block_records(row) -> Iterator[tuple]:
    position = row.anchor_position if row.anchor_position is not None else "child"
    blocks = (
        node
        for node in parse_page(row.html).descendants()
        if isinstance(node, Element)
        and node.name == row.container_tag
        and node.has_class(row.container_class)
    )
    for pos, block in enumerate(blocks):
        element = block.first(row.headline_tag)
        anchor = _anchor(element, position) if element is not None else None
        headline = element.text() if anchor is not None else None
        if not headline:
            continue
        summary = block.first(row.summary_tag)
        yield (
            row.site, row.page_num, pos, headline, anchor.attrs.get("href"),
            summary.text() if summary is not None else None, DATE_MARK,
        )


def _dom_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch = batch.astype(object).where(batch.notna(), None)
        rows = [record for row in batch.itertuples(index=False) for record in _block_records(row)]
        yield pd.DataFrame(rows, columns=_RECORD_FIELDS)


def html_dom_records(pages: DataFrame, configs: DataFrame) -> DataFrame:
    """Records from tag blocks, one job for all sites.

    A block gives a record if its headline element has text and an anchor is found; link and summary
    may be null. Nested containers give a record each.
    """
    wanted = configs.filter(F.col("strategy") == "html_dom").select(
        F.col("site_name").alias("site"), *_DOM_FIELDS
    )
    return (
        pages.filter(F.col("html").isNotNull())
        .join(wanted, "site")
        .select("site", "page_num", "html", *_DOM_FIELDS)
        .mapInPandas(_dom_batches, schemas.RECORDS)
    )


def extract_records(pages: DataFrame, configs: DataFrame) -> DataFrame:
    """Route every page to the strategy of its site; unknown strategies give no rows."""
    return json_script_records(pages, configs).unionByName(html_dom_records(pages, configs))


def extract_with_fallback(static_pages: DataFrame, browser: DataFrame, configs: DataFrame) -> DataFrame:
    """Extract from the static capture; sites that gave nothing are read from their browser capture.

    The first extraction is written once, since it is both returned and searched for its sites.
    """
    ensure_checkpoint_dir(static_pages.sparkSession)
    first = extract_records(static_pages, configs).checkpoint()
    served = first.select("site").distinct()
    second = extract_records(browser.join(served, "site", "left_anti"), configs)
    return first.unionByName(second)
