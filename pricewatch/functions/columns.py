"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewatch.schemas import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_col(as_of=None, ntz: bool = True) -> Column:
    """The query's notion of "now". Tests pass a constant; None means the
    current time. A constant folds to a literal, so time filters built on it
    reach the Parquet scan as pushed filters."""
    if as_of is None:
        now = F.current_timestamp()
        return now.cast("timestamp_ntz") if ntz else now
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp_ntz" if ntz else "timestamp")


def since(ts, hours: int, as_of=None, ntz: bool = True) -> Column:
    """``ts >= as_of - interval <hours> hours``."""
    return _col(ts) >= as_of_col(as_of, ntz) - F.make_dt_interval(hours=F.lit(int(hours)))


def valid_price(price) -> Column:
    """A price the detector may use: present, a number, above zero. A missing
    price counts as 0 and is invalid; NaN is treated as invalid as well."""
    p = _col(price)
    return p.isNotNull() & ~F.isnan(p) & (p > 0)


def to_number(text) -> Column:
    """Text or number to double; junk becomes null instead of failing."""
    return F.col(text).try_cast("double") if isinstance(text, str) else text.try_cast("double")


def listing_key(*parts) -> Column:
    """Joined listing key ``a_b_c_d_e``. A missing part is an empty string.
    concat_ws would skip null parts and shift the others, so plain concat of
    coalesced parts is used. Emit this for output only: partition by the
    parts themselves, since ``_`` also occurs inside ids."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("_"))
        pieces.append(F.coalesce(_col(p).cast("string"), F.lit("")))
    return F.concat(*pieces)


def money(x) -> Column:
    """Quantise to DECIMAL(10,2); a value out of range fails (ANSI)."""
    return _col(x).cast(MONEY)


def try_money(x) -> Column:
    """Quantise to DECIMAL(10,2); null when out of range."""
    return _col(x).try_cast(MONEY)


def parse_iso_ts(text, fallback=None) -> Column:
    """ISO-8601 text (``Z`` or an offset allowed) to timestamp; junk falls
    back to ``fallback`` (default: now)."""
    parsed = F.try_to_timestamp(_col(text))
    return F.coalesce(parsed, fallback if fallback is not None else F.current_timestamp())


def fixed(x, places: int) -> Column:
    """Fixed-point text with ``places`` decimals, rounded from the exact
    binary value with ties to even, as C and Python ``%.nf`` do (so 2.675
    gives 2.67 and 81.25 gives 81.2). ``format_string`` would round the
    shortest decimal form half-up instead. A pattern keeps out grouping."""
    pattern = "0." + "0" * places if places else "0"
    return F.call_function("format_number", _col(x), F.lit(pattern))


def fmt_money(x) -> Column:
    """``$12.50``."""
    return F.concat(F.lit("$"), fixed(x, 2))


def fmt_percent(x) -> Column:
    """``12.5%``."""
    return F.concat(fixed(x, 1), F.lit("%"))


def fmt_time(ts) -> Column:
    """``2024-01-31 12:00:00``."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def trunc_time(df, unit: str, ts: str) -> Column:
    """``date_trunc`` that keeps the column's own timestamp type (Spark's
    returns a zoned timestamp even for ``timestamp_ntz`` input)."""
    kind = df.schema[ts].dataType.simpleString()
    return F.date_trunc(unit, F.col(ts)).cast(kind)


def iso_text(ts) -> Column:
    """ISO-8601 text of a timestamp: ``2024-01-31T12:00:00``, with
    ``.ffffff`` only when there is a fraction of a second (as Python's
    ``isoformat`` writes it)."""
    t = _col(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "SSSSSS")
    return F.when(frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))
