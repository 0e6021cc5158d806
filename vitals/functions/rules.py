"""Cleaning and derivation rules as native Column expressions.

Each function maps Columns to a Column; nothing here leaves the JVM, so every
rule stays inside whole-stage code generation. Small fixed maps become literal
``map`` expressions (no join, no shuffle).
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitals import catalogues as C

# characters removed by a Python-style strip: the Unicode white space, which
# spreadsheets leave behind as non-breaking spaces
WS = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
      + "\u2028\u2029\u202f\u205f\u3000")
# text that Python reads as a number, white space around it (the cast alone would also take "45F", "3d", "0x1p3")
_BLANK = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WS) + "]*"
_NOT_BLANK = "[^" + _BLANK[1:-1]
# what ``icd_upper`` turns into a letter and two digits: only dotless i and long s are upper-cased to one of A-Z as well
_ICD = f"^{_BLANK}[A-Za-z\\x{{131}}\\x{{17f}}][0-9]{{2,4}}"
NUMBER = f"(?i)^{_BLANK}[+-]?(\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?{_BLANK}$|^{_BLANK}[+-]?(inf|infinity){_BLANK}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def literal_map(pairs) -> Column:
    """A literal MapType expression from (key, value) pairs."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs)])


def _printable(c: Column) -> Column:
    """The first character is printable ASCII, not a space."""
    return F.ascii(c).between(33, 126)


def strip(x) -> Column:
    """Unicode strip; text that begins and ends with printable ASCII is taken as it is."""
    s = _c(x)
    return F.when(_printable(s) & _printable(F.substring(s, -1, 1)), s).otherwise(F.btrim(s, F.lit(WS)))


def not_blank(x) -> Column:
    """Whether something is left after a strip (NULL of NULL), naming ``x`` once: a filter
    goes down to the scan, where each mention is the whole expression behind the column."""
    return _c(x).cast("string").rlike(_NOT_BLANK)


def blank_to_null(x) -> Column:
    """empty or whitespace-only text → NULL."""
    s = _c(x)
    return F.when(strip(s) == "", F.lit(None).cast("string")).otherwise(s)


def to_double(x) -> Column:
    """numeric coercion, bad text (and NaN) → NULL. Numbers pass through: the type
    of ``x`` is a constant of the plan, so only one branch is left of it."""
    own = _c(x)
    text = own.cast("string")
    number = F.typeof(own).isin("tinyint", "smallint", "int", "bigint", "double") | F.typeof(own).startswith("decimal")
    return F.nanvl(F.when(number, own.try_cast("double")).when(text.rlike(NUMBER), F.btrim(text, F.lit(WS)).try_cast("double")),
                   F.lit(None).cast("double"))


def to_long_or_zero(x) -> Column:
    """coerce, fill 0, truncate to integer."""
    return F.coalesce(to_double(x).try_cast("bigint"), F.lit(0).cast("bigint"))


def truncated_int(x) -> Column:
    """int(float(x)) or NULL."""
    return to_double(x).try_cast("bigint")


def classify_period(year, covid_start: int = 2020, covid_end: int = 2021) -> Column:
    """pre / COVID / post period, unparsable or NULL → "Ignorado"."""
    y = truncated_int(year)
    return (F.when(y.isNull(), F.lit(C.PERIOD_UNKNOWN))
            .when(y < covid_start, F.lit(C.PERIOD_PRE))
            .when(y <= covid_end, F.lit(C.PERIOD_COVID))
            .otherwise(F.lit(C.PERIOD_POST)))


def classify_period_covid(year, covid_end: int = 2021) -> Column:
    """local COVID source has no pre class."""
    y = truncated_int(year)
    return (F.when(y.isNull(), F.lit(C.PERIOD_UNKNOWN))
            .when(y <= covid_end, F.lit(C.PERIOD_COVID))
            .otherwise(F.lit(C.PERIOD_POST)))


def age_in_years(value, unit) -> Column:
    """1 = days, 2 = months (both rounded to 2 decimals), 3 = years, else NULL."""
    e, u = to_double(value), to_double(unit)
    return (F.when(u == 1, F.round(e / 365, 2))
            .when(u == 2, F.round(e / 12, 2))
            .when(u == 3, e)
            .otherwise(F.lit(None).cast("double")))


def _banded(age: Column, bands, top: str) -> Column:
    out = F.when(age.isNull(), F.lit(C.AGE_MISS))
    for upper, label in bands:
        out = out.when(age < upper, F.lit(label))
    return out.otherwise(F.lit(top))


def age_group(age_years) -> Column:
    """seven stage bands, NULL → "No especificado"."""
    return _banded(_c(age_years).cast("double"), C.STAGE_AGE_BANDS, C.STAGE_AGE_TOP)


def age_group_from_text(text) -> Column:
    """chronic-source age text → dimension band (first integer decides)."""
    s = F.lower(strip(_c(text).cast("string")))
    first = F.regexp_extract(s, r"(\d+)", 1)
    n = F.when(first != "", first.try_cast("bigint"))
    infant = s.contains("< 1") | s.contains("menor")
    banded = _banded(n, C.DIM_AGE_BANDS, C.DIM_AGE_TOP)
    return F.when(s.isNull(), F.lit(C.AGE_MISS)).when(infant, F.lit("< 1 anio")).otherwise(banded)


def age_label_to_dim(label) -> Column:
    """stage label → dimension label, miss → "No especificado"."""
    return F.coalesce(F.element_at(literal_map(C.AGE_LABEL_STAGE_TO_DIM), _c(label)),
                      F.lit(C.AGE_MISS))


def normalise_code(value) -> Column:
    """F8: str(int(float(v))) when numeric, else the stripped text. Plain integers are
    what they are; the rest is rare and stripped by the plain trim, which is less code per
    lookup (a stage with several lookups stays below what the JVM compiles)."""
    text = _c(value).cast("string")
    return F.when(text.rlike("^(0|[1-9][0-9]{0,14})$"), text).otherwise(
        F.coalesce(truncated_int(value).cast("string"), F.btrim(text, F.lit(WS))))


def icd_upper(code) -> Column:
    """strip + upper."""
    return F.upper(strip(_c(code).cast("string")))


def icd_normalise(code) -> Column:
    """strip, upper, drop ':'; blank → NULL."""
    s = _c(code).cast("string")
    return F.when(not_blank(s), F.replace(F.upper(strip(s)), F.lit(":"), F.lit("")))


def icd_valid(code) -> Column:
    """ICD-10 prefix pattern of the upper-cased, stripped text, no end anchor."""
    return F.coalesce(_c(code).cast("string").rlike(_ICD), F.lit(False))


def _first_letter(code) -> Column:
    return F.upper(F.substring(_c(code), 1, 1))


def icd_chapter_stage(code) -> Column:
    """F11 (stage wording): empty → "No especificado", unknown letter → "Capítulo no identificado"."""
    c = _c(code)
    hit = F.element_at(literal_map(C.ICD_CHAPTERS_STAGE), _first_letter(c))
    return (F.when(c.isNull() | (F.length(c) == 0), F.lit(C.ICD_CHAPTER_DIM_MISS))
            .otherwise(F.coalesce(hit, F.lit(C.ICD_CHAPTER_STAGE_MISS))))


def icd_chapter_dim(code) -> Column:
    """F11 (dimension wording): miss → "No especificado"."""
    hit = F.element_at(literal_map(C.ICD_CHAPTERS_DIM), _first_letter(code))
    return F.coalesce(hit, F.lit(C.ICD_CHAPTER_DIM_MISS))


def icd_category(code) -> Column:
    """category by first letter, miss → "Otra"."""
    hit = F.element_at(literal_map(C.ICD_CATEGORIES), _first_letter(code))
    return F.coalesce(hit, F.lit(C.ICD_CATEGORY_MISS))


def sex_normalise(code) -> Column:
    """F/M → label, anything else → "No especificado"."""
    hit = F.element_at(literal_map(C.SEX_CODE_TO_LABEL), F.upper(strip(_c(code).cast("string"))))
    return F.coalesce(hit, F.lit(C.SEX_MISS))


def sex_id(label) -> Column:
    """label → dimension id (case-sensitive), miss → 3."""
    return F.coalesce(F.element_at(literal_map(C.SEX_LABEL_TO_ID), _c(label)), F.lit(C.SEX_ID_MISS))


TITLE_MARK = "\u0001"  # never present in cleaned text; marks inserted word breaks


def title_case(text) -> Column:
    """strip + Python-style title case (a letter after any non-letter is upper-cased,
    other letters lower-cased); blank → NULL.

    ``initcap`` only starts words after a space, so a marked space is inserted
    after every other non-letter, ``initcap`` runs, and the marks are removed:
    three code-generated string functions instead of a per-character loop.
    """
    s = _c(text).cast("string")
    spaced = F.regexp_replace(strip(s), r"([^\p{L} ])", "$1" + TITLE_MARK + " ")
    return F.when(not_blank(s), F.replace(F.initcap(spaced), F.lit(TITLE_MARK + " "), F.lit("")))


def within_years(day, first: int, last: int) -> Column:
    """A day within whole years, as a range on the column itself, which
    reaches the scan (a predicate on ``year(day)`` does not)."""
    return (_c(day) >= F.lit(dt.date(first, 1, 1))) & (_c(day) < F.lit(dt.date(last + 1, 1, 1)))


def rate_per_100k(numerator, population) -> Column:
    """F16: round(n / p * 100000, 4), ties to even; NULL when population ≤ 0 or NULL."""
    n, p = to_double(numerator), to_double(population)
    return F.when(p > 0, F.bround(n / p * 100000, 4)).otherwise(F.lit(None).cast("double"))


def quarter_of(month) -> Column:
    """quarter, NULL for the annual member (month 0)."""
    m = _c(month)
    return F.when(m > 0, (F.floor((m - 1) / 3) + 1).cast("int"))


def split_time_unit(time, unit) -> tuple[Column, Column]:
    """(month, week) from a (time, time_unit) pair."""
    t = _c(time).cast("int")
    u = _c(unit)
    return (F.when(u == "monthly", t).otherwise(F.lit(None).cast("int")),
            F.when(u == "weekly", t).otherwise(F.lit(None).cast("int")))


def iso_week_month(year, week) -> Column:
    """Month of the Thursday of ISO week ``week`` of ``year`` (the month the week belongs to)."""
    jan4 = F.make_date(_c(year), F.lit(1), F.lit(4))
    iso_dow = (F.dayofweek(jan4) + 5) % 7 + 1  # Monday = 1 … Sunday = 7
    thursday = F.date_add(jan4, ((_c(week) - 1) * 7 + 4 - iso_dow).cast("int"))
    return F.month(thursday)


def who_region_name(code) -> Column:
    """WHO region code → readable name, miss → "Otro"."""
    return F.coalesce(F.element_at(literal_map(C.WHO_REGIONS), _c(code)), F.lit(C.WHO_REGION_MISS))


def excess_pct(observed, baseline) -> Column:
    """(obs - base) / base; a zero or NULL base gives NULL."""
    b = _c(baseline).cast("double")
    return F.try_divide(_c(observed).cast("double") - b, F.nullif(b, F.lit(0.0)))


def excess_label(pct, threshold: float = C.EXCESS_THRESHOLD) -> Column:
    return F.when(_c(pct) >= threshold, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num, den) -> Column:
    """F31 helper: division with zero_division = 0."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))
