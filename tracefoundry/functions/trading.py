"""Scalar functions of the trading domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import grouped, rounded

# fixed values: the direction vocabulary, the tickers, asset groups of the price format
LONG_WORDS = ("long", "longing", "buy", "bullish")
SHORT_WORDS = ("short", "shorting", "sell", "bearish")
DIRECTION_WORDS = ("long", "short", "longing", "shorting", "buy", "sell", "bullish", "bearish")
TICKERS = ("BTC", "ETH", "SOL", "BNB", "XRP", "DOGE", "AVAX", "ARB", "OP", "MATIC", "LINK", "UNI", "PEPE", "WIF")
ONE_DECIMAL = ("ETH", "SOL", "BNB", "AVAX")
PRICE_PATTERN = r"\$?(\d{1,7}(?:[.,]\d{1,4})?)\b"


def normalize_direction(raw: Column) -> Column:
    """``long`` or ``short`` for a known word in any case, else null."""
    word = F.lower(raw)
    return F.when(word.isin(*LONG_WORDS), F.lit("long")).when(word.isin(*SHORT_WORDS), F.lit("short"))


def first_word_of(text: Column, vocabulary: tuple[str, ...]) -> Column:
    """The first whole word of ``vocabulary`` in ``text``, any case, by Unicode word boundaries; null if none."""
    found = F.regexp_extract(text, rf"(?iU)\b({'|'.join(vocabulary)})\b", 1)
    return F.when(found != "", found)


def direction_in(text: Column, vocabulary: tuple[str, ...] = DIRECTION_WORDS) -> Column:
    return normalize_direction(first_word_of(text, vocabulary))


def symbol_in(text: Column, tickers: tuple[str, ...] = TICKERS) -> Column:
    """``BASE/USDT`` of the first ticker in ``text``; a quote or perpetual suffix changes nothing."""
    return F.concat(F.upper(first_word_of(text, tickers)), F.lit("/USDT"))


def prices_in(text: Column) -> Column:
    """All price-like numbers in ``text``."""
    return F.regexp_extract_all(text, F.lit(f"(?U){PRICE_PATTERN}"), 1)


def format_price(price: Column, symbol: Column) -> Column:
    """Dollars with as many decimals as the asset asks for; ``N/A`` for null."""
    name = F.upper(F.coalesce(symbol, F.lit("None")))
    one = F.lit(False)
    for asset in ONE_DECIMAL:
        one = one | name.contains(asset)
    body = F.when(name.contains("BTC"), grouped(price, 0)).when(one, grouped(price, 1)).otherwise(grouped(price, 4))
    return F.when(price.isNull(), F.lit("N/A")).otherwise(F.concat(F.lit("$"), body))


def verdict(pct: Column, win: float = 1.0, loss: float = -1.0) -> Column:
    """WIN above ``win``, LOSS below ``loss``, else SCRATCH."""
    return F.when(pct > win, F.lit("WIN")).when(pct < loss, F.lit("LOSS")).otherwise(F.lit("SCRATCH"))


def r_multiple(pct: Column, entry: Column, stop: Column) -> Column:
    """Result in units of the risk taken; null without a stop, a price or a risk."""
    risk = F.abs(entry - stop) / F.when(entry != 0, entry) * 100.0
    return rounded(pct / F.when(risk != 0, risk), 2)


def vwap(price: Column, qty: Column) -> Column:
    """Aggregate: volume-weighted price, 0 without volume."""
    volume = F.sum(qty)
    return F.when(volume == 0, F.lit(0.0)).otherwise(F.sum(price * qty) / F.when(volume != 0, volume))


def holding_bucket(hours: Column) -> Column:
    """scalp under 4 h, swing under 48 h, else position-trade."""
    return F.when(hours < 4, F.lit("scalp")).when(hours < 48, F.lit("swing")).otherwise(F.lit("position-trade"))
