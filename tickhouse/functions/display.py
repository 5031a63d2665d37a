"""Number and label texts of the human-readable report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")
MISSING = "—"
NO_BREAK = "\u00a0"
CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥", "INR": "₹"}


def _shown(known: Column, text: Column) -> Column:
    return F.when(known, text).otherwise(MISSING)


def bytes_text(value: Column) -> Column:
    """Binary-unit size: whole numbers for bytes and from ten up, else one decimal."""
    text = F.lit(None).cast("string")
    for step, unit in enumerate(BYTE_UNITS):
        size = value / F.lit(float(1024**step))
        plain = F.format_string(f"%.0f {unit}", size)
        shown = plain if step == 0 else F.when(size >= 10, plain).otherwise(
            F.format_string(f"%.1f {unit}", size)
        )
        text = shown if step == 0 else F.when(value >= 1024**step, shown).otherwise(text)
    return _shown(value.isNotNull(), text)


def duration_text(ms: Column) -> Column:
    text = F.when(ms < 1000, F.concat(F.format_number(ms, 0), F.lit(" ms"))).otherwise(
        F.format_string("%.1f s", ms / F.lit(1000.0))
    )
    return _shown(ms.isNotNull(), text)


def money_text(value: Column, currency: Column) -> Column:
    """Currency symbol when known, currency code otherwise; malformed codes go after the number."""
    symbols = F.create_map(*[F.lit(x) for pair in CURRENCY_SYMBOLS.items() for x in pair])
    sign = F.when(value < 0, "-").otherwise("")
    amount = F.format_string("%,.2f", F.abs(value))
    prefix = F.coalesce(F.try_element_at(symbols, currency), F.concat(currency, F.lit(NO_BREAK)))
    shown = F.when(currency.rlike("^[A-Z]{3}$"), F.concat(sign, prefix, amount)).otherwise(
        F.concat(F.format_string("%.2f", value), F.lit(" "), currency)
    )
    return _shown(value.isNotNull() & currency.isNotNull(), shown)


def title_text(code: Column) -> Column:
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def bar_height(value: Column, largest: Column, floor: float) -> Column:
    """Percent of the largest value, at least eight."""
    size = F.coalesce(value.cast("double"), F.lit(0.0))
    top = F.greatest(F.coalesce(largest.cast("double"), F.lit(0.0)), F.lit(floor))
    return F.greatest(F.lit(8.0), size / top * 100)


def cost_bar_height(cost: Column, largest: Column) -> Column:
    """Height of a cost by its absolute value; ``largest`` is the largest absolute cost, a cent at least."""
    return bar_height(F.abs(cost), largest, 0.01)
