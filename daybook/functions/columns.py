"""Column expressions. Everything here is lazy, JVM-side and null-safe unless it says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Series that are kept, and limits.
SERIES = ("EQ", "BE", "BZ")
MAX_PLAUSIBLE_FACTOR = 1000.0
FACTOR_TOLERANCE = 0.005
RATIO_TOLERANCE = 1e-6

#: Numbers as the files write them, between blanks. Keeps out what only one of two languages reads as
#: a number ("12d", "1_0", "NaN", "Infinity") and the marks of no value: such cells are null.
NUMBER = r"^ *([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?) *$"


def clean(c: Column) -> Column:
    """Trimmed text; null becomes empty."""
    return F.trim(F.coalesce(c, F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean(c), F.lit(""))


def to_double(c: Column) -> Column:
    """A number with thousands commas; anything unreadable is null. The text is cleaned once: one match gives the number or nothing."""
    return F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), NUMBER, 1).try_cast("double")


def to_long(c: Column) -> Column:
    """A number cut toward zero; beyond 64 bits null."""
    return to_double(c).try_cast("bigint")


def lakh_to_rupee(c: Column) -> Column:
    return c * F.lit(100000)


def by_header(df: DataFrame) -> DataFrame:
    """Headers without surrounding blanks. Of headers that then agree the exact one, else the first, stays."""
    seen: dict[str, str] = {}
    for name in sorted(df.columns, key=lambda n: n != n.strip()):
        seen.setdefault(name.strip(), name)
    return df.select(*(F.col(f"`{seen[n.strip()]}`").alias(n.strip()) for n in dict.fromkeys(seen[x.strip()] for x in df.columns)))


def field(df: DataFrame, name: str) -> Column:
    """The named column, or null where the file has none."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


#: A cell behind its comma, in quotes or not; what stands between its quotes.
_CELL, _QUOTED = r',( *"(?:[^"]++|"")*+"[^,]*|[^,]*)', r'^ *"((?:[^"]++|"")*+)"'
#: A cell behind its comma, if no quotes are doubled: what stands between its quotes, nothing after an open quote, or the cell.
_SIMPLE, _MARK = r', *"([^"]*+)"[^,]*|, *"[^,]*|,([^,]*)', "\x01"


def csv_cells(line: Column) -> Column:
    """A CSV line as an array of texts. Only lines with quotes are matched; those without doubled quotes in one go, others cell by cell."""
    behind = F.concat(F.lit(","), line)
    found = F.regexp_extract_all(behind, F.lit(_CELL), F.lit(1))
    plain = lambda c: F.when(F.ltrim(c).startswith('"'), F.replace(F.regexp_extract(c, _QUOTED, 1), F.lit('""'), F.lit('"'))).otherwise(c)
    odd = F.contains(line, F.lit('""')) | F.contains(line, F.lit(_MARK))
    simple = F.split(F.substring(F.regexp_replace(behind, _SIMPLE, f"{_MARK}$1$2"), 2, 1 << 30), _MARK, -1)
    return F.when(~F.contains(line, F.lit('"')), F.split(line, ",", -1)).when(odd, F.transform(found, plain)).otherwise(simple)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank, trimmed."""
    return F.coalesce(*map(blank_to_null, columns))


def dashed_date(c: Column) -> Column:
    """DD-MON-YYYY in any case; blank and bad dates are null."""
    return F.try_to_date(F.initcap(F.nullif(clean(c), F.lit("-"))), "dd-MMM-yyyy")


def candle_date(c: Column) -> Column:
    """The exchange's local date in an ISO timestamp: its first ten characters, whatever the offset."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def local_date(epoch_ms: Column, offset: str = "+05:30") -> Column:
    """The exchange's local date of an instant; the session's time zone must be UTC."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(epoch_ms), offset))


def compact_date(c: Column) -> Column:
    return F.date_format(c, "ddMMyyyy")


def sortable_date(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def month_name_date(c: Column) -> Column:
    return F.date_format(c, "dd-MMM-yyyy")


def instrument_key(isin: Column, exchange: str = "NSE_EQ") -> Column:
    return F.concat_ws("|", F.lit(exchange), isin)


def adjustment_factor(raw: Column, adjusted: Column) -> Column:
    """raw / adjusted; null if either is missing, zero or negative."""
    return F.when((raw > 0) & (adjusted > 0), raw / adjusted)


def agreed_ratio(raw: list[Column], adjusted: list[Column]) -> Column:
    """The ratio of the closes (the last of each list), if all ratios agree; null if any field is missing or zero."""
    whole = F.lit(True)
    for c in (*raw, *adjusted):
        whole = whole & c.isNotNull()
    for c in adjusted:
        whole = whole & (c != 0)
    ratios = [F.try_divide(r, a) for r, a in zip(raw, adjusted)]
    return F.when(whole & (F.greatest(*ratios) - F.least(*ratios) <= RATIO_TOLERANCE), ratios[-1])


def volume_consistent(factor: Column, raw: Column, adjusted: Column) -> Column:
    """Does volume move inversely to price? False if either volume is missing or zero."""
    expected = F.try_divide(F.lit(1.0), factor)
    ratio = F.try_divide(raw.cast("double"), F.nullif(adjusted.cast("double"), F.lit(0.0)))
    return F.coalesce((raw != 0) & (F.abs(ratio - expected) <= FACTOR_TOLERANCE * F.greatest(expected, F.lit(1.0))), F.lit(False))


def plain_detail(c: Column, width: int = 300) -> Column:
    """Text that is safe in an alert: control characters as blanks, no @ and no backticks, cut to width."""
    return F.left(F.trim(F.regexp_replace(F.regexp_replace(c, r"[\x00-\x1f\x7f]+", " "), "[@`]", "")), F.lit(width))


def redacted(c: Column, secret: str, width: int = 200) -> Column:
    return F.left(F.replace(c, F.lit(secret), F.lit("***")) if secret else c, F.lit(width))


def row_key(*columns: Column) -> Column:
    """The columns as one text; null if any is null."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & c.isNotNull()
    return F.when(whole, F.concat_ws("|", *(c.cast("string") for c in columns)))
