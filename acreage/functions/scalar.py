"""Row-wise column expressions; none of them needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from acreage.constants import BOROUGH_CODES, BOROUGH_SPELLINGS

#: White space of Unicode, and the four separators that Python also strips.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_NUMBER = r"^([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?)))$"


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.btrim(c, F.lit(_BLANKS))


def literal_map(values: dict) -> Column:
    """Dictionary as a map literal, for lookups that need no join."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def clean_text(c: Column) -> Column:
    return F.lower(strip(c))


def borough_name(c: Column) -> Column:
    """County names and variants to one spelling; an unknown value is kept as it is."""
    return F.coalesce(literal_map(BOROUGH_SPELLINGS)[clean_text(c)], c)


def borough_from_code(c: Column) -> Column:
    return literal_map(BOROUGH_CODES)[c.cast("int")]


def property_type(c: Column) -> Column:
    """Drop a trailing 'for sale', then a trailing 'for rent'."""
    sale = F.regexp_replace(c, r"\s+for\s+sale$", "")
    return strip(F.regexp_replace(sale, r"\s+for\s+rent$", ""))


def zipcode(c: Column) -> Column:
    """First run of five digits; `00000` when there is none."""
    found = F.regexp_extract(c.cast("string"), r"(\d{5})", 1)
    return F.when(found.isNull() | (found == ""), F.lit("00000")).otherwise(found)


def canonical_category(c: Column) -> Column:
    """Categories as the models see them; a missing value becomes the text `nan`."""
    return F.coalesce(clean_text(c.cast("string")), F.lit("nan"))


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a value and keep null; `greatest` and `least` would replace it."""
    out = c
    if high is not None:
        out = F.when(c > high, high).otherwise(out)
    if low is not None:
        out = F.when(c < low, low).otherwise(out)
    return out


def cut(c: Column, edges: list[float], labels: list) -> Column:
    """Right-closed bins whose first bin includes its left edge; outside is null."""
    out = F.when(c < edges[0], F.lit(None))
    for edge, label in zip(edges[1:], labels):
        out = out.when(c <= edge, F.lit(label))
    return out


def ordinal(c: Column, labels: list[str]) -> Column:
    """Position of a label in its natural order."""
    return literal_map({label: i for i, label in enumerate(labels)})[c]


def coerce_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text with thousands separators to a double; anything else becomes null."""
    if dtype is not None and isinstance(dtype, T.NumericType):
        return nan_to_null(c.cast("double"))
    text = F.replace(c.cast("string"), F.lit(","), F.lit(""))
    return F.regexp_extract(strip(text), _NUMBER, 1).try_cast("double")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column, once, at ingest."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: nan_to_null(F.col(f"`{name}`")) for name in floats})


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def coordinate_key(c: Column) -> Column:
    """Value at four decimals as an integer, rounded half to even."""
    return F.rint(c * F.lit(10000.0))


def nearest_hundred(c: Column) -> Column:
    return F.bround(c, -2)


def argmax(p: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def thresholded_argmax(p: Column, thresholds: list[float]) -> Column:
    """First position of the largest probability relative to its class threshold."""
    scaled = F.zip_with(p, F.array(*[F.lit(float(t)) for t in thresholds]), lambda x, t: x / t)
    return argmax(scaled)


def direction(c: Column) -> Column:
    return F.when(c > 0, F.lit("+")).otherwise(F.lit("-"))
