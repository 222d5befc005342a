"""Text rules: labels, contact links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packhouse.functions.numbers import dbl

DASH = "—"
UNKNOWN = "Unknown"


def plain_number(x: Column) -> Column:
    """Shortest text of a number: 4, 0.25."""
    x = dbl(x)
    whole = F.floor(x)
    return F.when(x == dbl(whole), whole.cast("string")).otherwise(x.cast("string"))


def pack_label(name: Column, size: Column, packs: Column) -> Column:
    """``Tomato (0.25kg × 4)`` where both pack figures are present and non-zero."""
    shown = (F.coalesce(dbl(size), F.lit(0.0)) != 0) & (F.coalesce(dbl(packs), F.lit(0.0)) != 0)
    packed = F.concat(name, F.lit(" ("), plain_number(size), F.lit("kg × "), plain_number(packs), F.lit(")"))
    return F.when(shown, packed).otherwise(name)


def repack_label(label: Column, size: Column, packs: Column) -> Column:
    """Replace the pack part of a line label, or add one."""
    part = F.concat(F.lit("("), plain_number(size), F.lit("kg × "), plain_number(packs), F.lit(")"))
    return F.when(F.contains(label, F.lit("(")), F.regexp_replace(label, F.lit(r"\(.*\)"), part)).otherwise(
        F.concat_ws(" ", label, part)
    )


def digits_only(phone: Column) -> Column:
    return F.regexp_replace(F.coalesce(phone, F.lit("")), r"\D", "")


def url_component(text: Column) -> Column:
    """Percent-encode a text for a URL, leaving ``! ' ( ) *`` as they are."""
    out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    # Characters a URL component keeps but form encoding escapes, and the reverse.
    for code, char in {"%21": "!", "%27": "'", "%28": "(", "%29": ")", "%7E": "~"}.items():
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def contact_link(phone: Column, message: Column) -> Column:
    return F.concat(F.lit("https://wa.me/"), digits_only(phone), F.lit("?text="), url_component(message))


def order_label(client_name: Column, delivery_date: Column, order_id: Column) -> Column:
    """``client - date``, or the first 8 characters of the id where the order is not known."""
    return F.coalesce(F.concat(client_name, F.lit(" - "), delivery_date.cast("string")), F.substring(order_id, 1, 8))
