"""Wire values as Spark values. Each function gives null where it refuses its input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip takes off.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})$"
TIMESPAN = r"^(?:\d+\.)?(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,7})?$"


def strip(text: Column) -> Column:
    """Without white space at either end, Unicode's included."""
    return F.btrim(text, F.lit(SPACE))


def timespan_micros(text: Column) -> Column:
    """Microseconds of ``[d.]hh:mm:ss[.f{1,7}]``; hours to 23, minutes and seconds to 59; a seventh digit is cut off.

    One pattern checks the grammar; the parts are then cut at fixed characters, which costs less than more patterns."""
    parts = F.split(text, ":")
    first, last = F.get(parts, F.lit(0)), F.get(parts, F.lit(2))
    number = lambda x: x.try_cast("bigint")
    dotted = lambda x, found: F.when(F.contains(x, F.lit(".")), found).otherwise(F.lit(0).cast("bigint"))
    days = dotted(first, number(F.substring_index(first, ".", 1)))
    hours, minutes, seconds = number(F.substring_index(first, ".", -1)), number(F.get(parts, F.lit(1))), number(F.substring_index(last, ".", 1))
    micros = dotted(last, number(F.rpad(F.substring_index(last, ".", -1), 6, "0")))
    total = (((days * 24 + hours) * 60 + minutes) * 60 + seconds) * 1_000_000 + micros
    return F.when(text.rlike(TIMESPAN), total)


def micros_to_interval(micros: Column) -> Column:
    return F.lit(timedelta(microseconds=1)) * micros


def interval_to_micros(interval: Column) -> Column:
    """For comparing with engines that hold durations as whole microseconds."""
    return F.unix_micros(F.timestamp_seconds(F.lit(0)) + interval)


def timespan(text: Column) -> Column:
    """.NET TimeSpan text as a day-time interval."""
    return micros_to_interval(timespan_micros(text))


def epoch_millis(number: Column) -> Column:
    return F.timestamp_millis(number)


def to_epoch_millis(time: Column) -> Column:
    return F.unix_millis(time)


def date_label(text: Column) -> Column:
    """Exactly ``YYYY-MM-DD``, as midnight UTC."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 with an offset, as UTC; text without offset is refused. Only text that is written with a comma or small
    letters is rewritten before the cast."""
    rare = F.contains(text, F.lit(",")) | F.contains(text, F.lit("t")) | F.contains(text, F.lit("z"))
    return F.when(text.rlike(ISO_WITH_OFFSET), F.when(rare, F.translate(text, ",tz", ".TZ")).otherwise(text).try_cast("timestamp"))


def to_iso(time: Column) -> Column:
    """``…Z`` text of whole seconds; what is below a second is dropped."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_date(time: Column) -> Column:
    """The calendar date in a session whose time zone is UTC."""
    return F.to_date(time)


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID (JSON null); null where nothing is there. It walks
    the whole value: for objects and arrays that may be large, use is_object and is_array."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def is_object(value: Column) -> Column:
    """Taken as a struct without fields, for which no member is looked at."""
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def is_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def get(value: Column, *keys: str) -> Column:
    """The variant at ``keys``; null where any step is missing."""
    steps = "".join(f"['{k}']" if "." in k or "-" in k else f".{k}" for k in keys)
    return F.try_variant_get(value, f"${steps}", "variant")


def shape(value: Column) -> Column:
    """The type of a variant as text: STRING, BIGINT, BOOLEAN, VOID and so on, DECIMAL(p,s), OBJECT<...>, ARRAY<...>. The
    functions below take it as their second argument where it is already known, as it costs more than a value does."""
    return F.schema_of_variant(value)


def text_of(value: Column, known: Column | None = None) -> Column:
    return F.when((shape(value) if known is None else known) == "STRING", F.try_variant_get(value, "$", "string"))


def reference_id(value: Column) -> Column:
    """The id of a reference that is a bare string or an object with an id."""
    return F.when(kind(value) == "STRING", value).otherwise(get(value, "id"))


def id_list(value: Column) -> Column:
    """array<string> of elements that are each a bare string or exactly {"id": string}; anything else refuses all."""
    whole = F.try_variant_get(value, "$", "array<variant>")
    one = lambda x: F.when(kind(x) == "STRING", text_of(x)).when(F.schema_of_variant(x) == "OBJECT<id: STRING>", text_of(get(x, "id")))
    ids = F.transform(whole, one)
    return F.when((kind(value) == "ARRAY") & ~F.exists(ids, lambda x: x.isNull()), ids)


def is_number(known: Column) -> Column:
    return known.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(known, F.lit("DECIMAL"))


def whole_number(value: Column, known: Column | None = None, text: Column | None = None) -> Column:
    """A number without a fraction, a boolean, or text of a whole number; never one that would lose its fraction."""
    known = shape(value) if known is None else known
    text = strip(text_of(value, known)) if text is None else text
    number = F.try_variant_get(value, "$", "decimal(38,18)")
    from_number = F.when(number == F.floor(number), number.try_cast("bigint"))
    from_text = F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), F.substring_index(text, ".", 1).try_cast("bigint"))
    return F.when(known == "BIGINT", F.try_variant_get(value, "$", "bigint")).when(is_number(known), from_number).when(known == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint")).otherwise(from_text)


def number(value: Column, known: Column | None = None, text: Column | None = None) -> Column:
    known = shape(value) if known is None else known
    text = strip(text_of(value, known)) if text is None else text
    return F.when(is_number(known), F.try_variant_get(value, "$", "double")).when(known == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")).otherwise(F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double")))


def boolean(value: Column, known: Column | None = None, text: Column | None = None) -> Column:
    """A boolean, the numbers 0 and 1, or one of the usual words for them."""
    known = shape(value) if known is None else known
    text = strip(text_of(value, known)) if text is None else text
    # only letters that the words have are made small: lower() asks ICU about each text, and costs many times as much
    small = F.translate(text, "AEFLNORSTUY", "aeflnorstuy")
    as_number = F.try_variant_get(value, "$", "double")
    return (
        F.when(known == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(is_number(known) & as_number.isin(0.0, 1.0), as_number == 1.0)
        .when(small.isin("1", "on", "t", "true", "y", "yes"), F.lit(True))
        .when(small.isin("0", "off", "f", "false", "n", "no"), F.lit(False))
    )


def written(value: Column, lift: str | None = None, known: Column | None = None) -> Column:
    """The text of a variant as coerced() reads it: stripped, but as it stands for the lifts of fixed grammars."""
    text = text_of(value, known)
    return text if lift in ("timespan", "datelabel") else strip(text)


def coerced(value: Column, scalar: str, lift: str | None = None, known: Column | None = None, text: Column | None = None) -> Column:
    """A variant as one of the scalar types, laxly but without loss; null where it is refused. ``text``: written(), where it
    is a column already, as most types look at it several times."""
    known = shape(value) if known is None else known
    text = written(value, lift, known) if text is None else text
    if lift == "timespan":
        return timespan(text)
    if lift == "epochms":
        return F.when(known == "BIGINT", epoch_millis(F.try_variant_get(value, "$", "bigint")))
    if lift == "datelabel":
        return date_label(text)
    if scalar == "STRING":
        return text
    if scalar == "TIMESTAMP":
        return iso_timestamp(text)
    if scalar == "DATE":
        return F.to_date(date_label(text))
    return {"BIGINT": whole_number, "DOUBLE": number, "BOOLEAN": boolean}[scalar](value, known, text)
