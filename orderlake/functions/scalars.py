"""Small ``Column -> Column`` expressions; all stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import settings


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- numbers -----------------------------------------------------------------------------


def to_whole(value) -> Column:
    """Strict whole number; '31.0' is 31, '3.7' rounds to 4, junk raises."""
    return _col(value).cast("decimal(38,0)").cast("bigint")


def try_whole(value) -> Column:
    """As ``to_whole`` but NULL instead of an error."""
    return _col(value).try_cast("decimal(38,0)").try_cast("bigint")


def try_amount(value, precision: int = 10, scale: int = 2) -> Column:
    return _col(value).try_cast(f"decimal({precision},{scale})")


def first_whole(value) -> Column:
    """First run of digits in a text ('100+ ratings' -> 100), NULL when there is none."""
    return try_whole(F.regexp_substr(_col(value), F.lit("[0-9]+")))


def ratio(numerator, divisor, digits: int | None = None) -> Column:
    """Division that gives 0 for a zero divisor and NULL for a NULL input."""
    a, b = _col(numerator).cast("double"), _col(divisor).cast("double")
    out = F.when(a.isNull() | b.isNull(), F.lit(None)).when(b == 0, F.lit(0.0)).otherwise(a / b)
    return out if digits is None else F.round(out, digits)


def _unless_null(result: Column, *inputs: Column) -> Column:
    missing = inputs[0].isNull()
    for column in inputs[1:]:
        missing = missing | column.isNull()
    return F.when(~missing, result)


def strict_greatest(*values) -> Column:
    """``greatest`` that is NULL as soon as one input is."""
    columns = [_col(v) for v in values]
    return _unless_null(F.greatest(*columns), *columns)


def strict_least(*values) -> Column:
    columns = [_col(v) for v in values]
    return _unless_null(F.least(*columns), *columns)


# --- text --------------------------------------------------------------------------------


def city_of(value) -> Column:
    """Text after the last comma, trimmed ('Indiranagar,Bangalore' -> 'Bangalore')."""
    raw = _col(value)
    return F.trim(F.coalesce(F.regexp_substr(raw, F.lit("[^,]+$")), raw))


def text_or_null(value, tokens=settings.NULL_TOKENS) -> Column:
    raw = _col(value)
    return F.when(~raw.isin(*tokens), raw)


def mask_email(value) -> Column:
    """Hide the part before the @ sign."""
    return F.regexp_replace(_col(value), "^[^@]+", "*****")


def text_hash(value) -> Column:
    return F.sha2(_col(value), 256)


# --- load metadata -----------------------------------------------------------------------


def file_date(source_file="_source_file") -> Column:
    """The date in a file's ``dt=`` folder; NULL where the path has none or no real date."""
    day = F.regexp_extract(_col(source_file), "dt=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.when(day != "", day).try_cast("date")


def loaded_at(column="_loaded_at", default: str = settings.INITIAL_LOAD_AT) -> Column:
    return F.coalesce(_col(column), F.lit(default).cast("timestamp"))


# --- dates -------------------------------------------------------------------------------


def days_between(earlier, later) -> Column:
    """Number of midnights between two dates or timestamps."""
    return F.datediff(_col(later).cast("date"), _col(earlier).cast("date"))


# --- vectors -----------------------------------------------------------------------------


def vector_from_json(value, dimension: int | None = None) -> Column:
    """JSON text as a vector; NULL for other text and, where a dimension is given, other lengths."""
    vector = F.from_json(_col(value), "array<float>")
    return vector if dimension is None else F.when(F.size(vector) == dimension, vector)


def dot(a, b) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when a vector has no length or the dimensions differ."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    same = F.size(_col(a)) == F.size(_col(b))
    return F.when(same & (norms > 0), dot(a, b) / norms)
