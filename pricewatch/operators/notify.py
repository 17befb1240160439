"""Notification payload for a price-drop alert, built as a column.

The message is a chat-webhook "embed": a title, the event in bold, five
fields, a timestamp, a footer and, when the listing has a usable url, a link.
Nothing is sent from Spark; the payload column is what a sender posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import fixed
from pricewatch.functions.columns import fmt_money, fmt_percent, iso_text

TITLE, COLOR = fixed.MSG_TITLE, fixed.MSG_COLOR
DEFAULT_FOOTER = "Price Monitor"


def _or(c: str, default: str) -> Column:
    return F.coalesce(F.col(c), F.lit(default))


def _num(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def message_texts(alerts: DataFrame) -> DataFrame:
    """The formatted text pieces of the message, one column each."""
    return alerts.withColumns({
        "msg_description": F.concat(F.lit("**"), _or("event_name", fixed.MSG_UNKNOWN_EVENT), F.lit("**")),
        "msg_venue": _or("venue", fixed.MSG_UNKNOWN_VENUE),
        "msg_seat": F.format_string("%s Row %s Seat %s", _or("section", fixed.MSG_UNKNOWN_SECTION),
                                    _or("row", fixed.MSG_NO_ROW_OR_SEAT),
                                    _or("seat", fixed.MSG_NO_ROW_OR_SEAT)),
        "msg_price": F.concat(fmt_money(_num("old_price")), F.lit(" → **"),
                              fmt_money(_num("new_price")), F.lit("**")),
        "msg_drop": F.concat(fmt_money(_num("drop_amount")), F.lit(" ("),
                             fmt_percent(_num("drop_percent")), F.lit(")")),
        "msg_source": F.upper(_or("source", fixed.MSG_UNKNOWN_SOURCE)),
    })


def with_payload(alerts: DataFrame, footer: str = DEFAULT_FOOTER, out: str = "payload") -> DataFrame:
    """Add the JSON payload. ``url`` is present only when the listing url is
    set and not ``#`` (null struct fields are left out by ``to_json``)."""
    t = message_texts(alerts)

    def field(name, value, inline):
        return F.struct(F.lit(name).alias("name"), F.col(value).alias("value"),
                        F.lit(inline).alias("inline"))

    url = F.col("listing_url")
    embed = F.struct(
        F.lit(TITLE).alias("title"),
        F.col("msg_description").alias("description"),
        F.lit(COLOR).alias("color"),
        F.array(field(fixed.MSG_FIELD_VENUE, "msg_venue", True),
                field(fixed.MSG_FIELD_SECTION, "msg_seat", True),
                field(fixed.MSG_FIELD_PRICE, "msg_price", False),
                field(fixed.MSG_FIELD_DROP, "msg_drop", True),
                field(fixed.MSG_FIELD_SOURCE, "msg_source", True)).alias("fields"),
        iso_text("alert_timestamp").alias("timestamp"),
        F.struct(F.lit(footer).alias("text")).alias("footer"),
        F.when(url.isNotNull() & (url != "") & (url != "#"), url).alias("url"),
    )
    payload = F.to_json(F.struct(F.array(embed).alias("embeds")))
    return t.withColumn(out, payload).drop(*[c for c in t.columns if c.startswith("msg_")])
