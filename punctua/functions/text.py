"""Text helpers: identifiers, labels, slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# German letters and their spelling in plain ASCII.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "ß": "ss"}


def line_id_padded(line_id: Column) -> Column:
    """First three ``:`` parts; missing parts stay as empty text, NULL gives ''."""
    parts = [F.split_part(line_id, F.lit(":"), F.lit(n)) for n in (1, 2, 3)]
    return F.when(line_id.isNull(), F.lit("")).otherwise(F.concat_ws(":", *parts))


def line_id_prefix(line_id: Column) -> Column:
    """First three ``:`` parts, without padding shorter ids."""
    return F.substring_index(line_id, ":", 3)


def client_id(device_id: Column) -> Column:
    """Third ``#`` part of a device id, or '-' if there are fewer parts."""
    return F.coalesce(F.get(F.split(device_id, "#"), F.lit(2)), F.lit("-"))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def clock_text(stamp: Column) -> Column:
    """'yyyyMMddHHmmss' to 'HH:mm'; anything of ten characters or fewer to ''."""
    clock = F.concat(F.substring(stamp, 9, 2), F.lit(":"), F.substring(stamp, 11, 2))
    return F.when(F.length(stamp) > 10, clock).otherwise(F.lit(""))


def transliterate(value: Column) -> Column:
    for letter, plain in UMLAUTS.items():
        value = F.replace(value, F.lit(letter), F.lit(plain))
    return value


def slug(value: Column) -> Column:
    """Name usable in a file name or address: ASCII, lower case, no blanks."""
    return F.lower(F.replace(transliterate(value), F.lit(" "), F.lit("_")))


def stop_label(station_name: Column) -> Column:
    """Stop name without its leading place name, cut to eight characters."""
    place = F.substring_index(station_name, " ", 1)
    rest = F.substring(station_name, F.length(place) + 2, F.length(station_name))
    return F.when(rest == "", F.substring(place, 1, 8)).otherwise(F.substring(rest, 1, 8))


def indexed_stop_label(idx: Column, station_name: Column) -> Column:
    number = idx.cast("string")
    # lpad would cut numbers of three digits
    number = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return F.concat(number, F.lit(" "), stop_label(station_name))


def complement_percent(share: Column) -> Column:
    """Percent text of ``1 - share``, cut to one decimal; '-' marks no value (-1)."""
    tenths = ((1 - share) * 1000).cast("bigint")
    text = F.format_string("%.1f%%", tenths / F.lit(10.0))
    return F.when(share.cast("int") == -1, F.lit("-")).otherwise(text)


def letter_code(name: Column) -> Column:
    """1000 plus the alphabet positions (a = 0) of a name's letters, as text."""
    plain = F.lower(name)
    for letter in ("ü", "ä", "ö"):
        plain = F.replace(plain, F.lit(letter), F.lit(UMLAUTS[letter]))
    letters = F.filter(F.split(plain, ""), lambda c: c.between("a", "z"))
    total = F.aggregate(letters, F.lit(1000), lambda acc, c: acc + F.ascii(c) - F.lit(97))
    return total.cast("string")


def display_text(df: DataFrame, missing: str = "-") -> DataFrame:
    """Every column as text with a mark for NULL, for printed reports only."""
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias(c) for c in df.columns])
