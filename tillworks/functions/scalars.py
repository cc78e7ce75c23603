"""Scalar column functions. All are built from Spark's own expressions."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Text


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; null when either part is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def display_name(name: Column | str, country: Column | str) -> Column:
    """``name (country)``; null when either part is null."""
    return F.concat(_col(name), F.lit(" ("), _col(country), F.lit(")"))


def code(value: Column | str) -> Column:
    return F.upper(F.trim(_col(value)))


def normalized(value: Column | str) -> Column:
    return F.lower(F.trim(_col(value)))


def pair_name(pair: Column | str) -> Column:
    """The name in ``id:name``, or the whole text when it has no colon."""
    pair = _col(pair)
    return F.when(F.contains(pair, F.lit(":")), F.split_part(pair, F.lit(":"), F.lit(2))).otherwise(
        pair
    )


# Dates


def text_date(value: Column | str) -> Column:
    return F.to_date(_col(value))


def epoch_millis_date(value: Column | str) -> Column:
    return F.timestamp_millis(_col(value)).cast("date")


def truncated(unit: str, value: Column | str) -> Column:
    """Start of the unit: a date for day and above, a timestamp for hours. No step goes through
    the session's time zone."""
    value = _col(value)
    if unit == "hour":
        second = F.extract(F.lit("SECOND"), value)
        return value - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(value), second)
    if unit == "day":
        return value.cast("date")
    return F.trunc(value, unit)


def weekday(value: Column | str) -> Column:
    """Day of the week, Sunday is 0."""
    return F.dayofweek(_col(value)) - 1


def year_month(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyy-MM")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.date_diff(_col(end), _col(start))


def age_days(value: Column | str, as_of: str | Column) -> Column:
    """Days from a date up to the reference date."""
    today = F.lit(as_of).cast("date")
    return F.date_diff(today, _col(value))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps, with their fraction."""
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(18,6)")
    return seconds.cast("double") / 60


# Numbers


def half_up(value: Column, places: int) -> Column:
    """A double rounded half up, once, at its shortest decimal form: x.xx5 is what it looks like."""
    return F.round(value.cast("double"), places)


# Exact for whole numbers and decimals of up to 9 places and 19 digits before the point.
_EXACT = "decimal(28,9)"


def _quotient(part: Column, whole: Column, places: int, times: int) -> Column:
    """``times * part / whole`` rounded half up, away from zero: twice the scaled part and one
    whole are divided by two wholes, in whole numbers, so that nothing is rounded before. Null
    when the whole is not positive."""
    whole = F.when(whole > 0, whole).cast(_EXACT)
    scaled = F.abs(part.cast(_EXACT)) * F.lit(Decimal(2 * times * 10**places))
    steps = F.call_function("div", scaled + whole, whole + whole)
    return F.signum(part.cast("double")) * steps / 10**places


def exact_mean(value: Column | str) -> Column:
    """Mean of a decimal or integer column, from its exact sum; null without values."""
    value = _col(value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def ratio(part: Column, whole: Column, places: int, otherwise: float | None = 0.0) -> Column:
    """``part / whole`` rounded, or ``otherwise`` when the whole is not positive. Both sides are
    whole numbers or decimals."""
    quotient = _quotient(part, whole, places, 1)
    return F.when(whole > 0, quotient).otherwise(F.lit(otherwise).cast("double"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """Share of a whole in percent, 0 when the whole is not positive."""
    return F.when(whole > 0, _quotient(part, whole, places, 100)).otherwise(F.lit(0.0))


def completeness(nulls: Column, rows: Column, columns: int) -> Column:
    """Percent of filled cells, 0 without rows."""
    filled = 1 - nulls.cast("double") / (rows * columns).cast("double")
    return F.when(rows > 0, filled * 100).otherwise(F.lit(0.0))


def cents_to_dollars(cents: Column | str, places: int = 2) -> Column:
    return F.round(_col(cents).cast("decimal(18,2)") / F.lit(100).cast("decimal(3,0)"), places)


def line_subtotal(unit_price: Column | str, quantity: Column | str) -> Column:
    return _col(unit_price) * _col(quantity)


def net_price(subtotal: Column | str, discount: Column | str) -> Column:
    """Subtotal after discount, kept within 18 digits so that it stays a machine word."""
    return (_col(subtotal) * (1 - _col(discount))).cast("decimal(18,7)")


def discount_amount(subtotal: Column | str, discount: Column | str) -> Column:
    return (_col(subtotal) * _col(discount)).cast("decimal(18,7)")


# Flags


def flag(predicate: Column) -> Column:
    """True or false; an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def sum_where(predicate: Column, value: Column | str) -> Column:
    """Sum over the matching rows, 0 for the others."""
    value = _col(value)
    return F.sum(F.when(predicate, value).otherwise(0))


# JSON


def json_text(document: Column | str, *path: str) -> Column:
    """Text at a path of a JSON document."""
    return F.get_json_object(_col(document), "$." + ".".join(path))
