"""Price payloads: nested JSON or maps flattened to one row per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

PRICE_JSON = "map<string,struct<usd:double,usd_24h_change:double>>"
TICKER_JSON = "map<string,struct<current:double,prev_close:double>>"


def scan_prices(payloads: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per coin of every payload: ``coin, usd, usd_24h_change``."""
    return _flatten(payloads, body, keep, PRICE_JSON, "coin")


def scan_tickers(payloads: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per symbol of every batch: ``symbol, current, prev_close``."""
    return _flatten(payloads, body, keep, TICKER_JSON, "symbol")


def _flatten(payloads: DataFrame, body: str, keep: tuple[str, ...], kind: str, key: str) -> DataFrame:
    parsed = F.col(body)
    if isinstance(payloads.schema[body].dataType, T.StringType):
        parsed = F.from_json(parsed, kind)
    return payloads.select(*keep, F.explode(parsed).alias(key, "_value")).select(*keep, key, "_value.*")
