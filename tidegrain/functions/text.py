"""Text column helpers: contacts, masks, cleaning, record parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from titles and from free text.
TITLE_JUNK = "*#$%@€"
TEXT_JUNK = "#$%&/()"
# Public mail providers.
PUBLIC_MAIL = ("@gmail.", "@yahoo.", "@hotmail.", "@outlook.")


def normalise_phone(c: Column) -> Column:
    return F.translate(c, "()- ", "")


def email_domain(c: Column) -> Column:
    """Text after the first ``@``; the whole text when there is none."""
    return F.expr("substring({0}, instr({0}, '@') + 1)".format(_name(c))) if isinstance(c, str) else F.substring(
        c, F.instr(c, "@") + F.lit(1), F.lit(2147483647)
    )


def _name(c: str) -> str:
    return f"`{c}`"


def domain_class(c: Column) -> Column:
    public = F.lit(False)
    for mark in PUBLIC_MAIL:
        public = public | c.ilike(f"%{mark}%")
    return F.when(public, "Public").otherwise("Corporate")


def username(first: Column, last: Column) -> Column:
    return F.substring(F.concat(F.lower(F.substring(first, 1, 1)), F.lower(last)), 1, 10)


def mask_email(c: Column) -> Column:
    return F.concat(F.lit("****"), F.substring(c, F.instr(c, "@"), F.lit(2147483647)))


def mask_secret(c: Column, env: Column) -> Column:
    """Stars of equal length in production, clear text in development, NULL elsewhere."""
    return F.when(env == "Production", F.repeat(F.lit("*"), F.length(c))).when(env == "Development", c)


def remove_words(c: Column, words: list[str]) -> Column:
    for word in words:
        c = F.replace(c, F.lit(word), F.lit(""))
    return c


def strip_thousands(c: Column) -> Column:
    """``'1,234,567'`` to a number; text that is no number becomes NULL."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def decimal_comma(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def clean_text(c: Column, junk: str = TEXT_JUNK) -> Column:
    """Trim, drop junk characters, capitalise the first letter only."""
    return capitalise(F.translate(F.trim(c), junk, ""))


def clean_title(c: Column, default: str = "Unknown Track") -> Column:
    """Title case that keeps acronyms unless the whole title is in capitals; spaces collapse."""
    stripped = F.trim(F.translate(c, TITLE_JUNK, ""))
    words = F.filter(F.split(stripped, r"\s+"), lambda w: F.length(w) > 0)
    shouting = (stripped == F.upper(stripped)) & (stripped != F.lower(stripped))
    kept = F.transform(
        words,
        lambda w: F.when((w == F.upper(w)) & (w != F.lower(w)) & ~shouting, w).otherwise(capitalise(w)),
    )
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(default)).otherwise(F.array_join(kept, " "))


def parse_kv(c: Column) -> Column:
    """``K:V|K:V`` record to a struct of typed fields."""
    m = F.str_to_map(c, F.lit("\\|"), F.lit(":"))
    return F.struct(
        F.try_element_at(m, F.lit("SENSOR_ID")).try_cast("bigint").alias("sensor_id"),
        F.try_element_at(m, F.lit("TEMP")).try_cast("double").alias("temperature"),
        F.try_element_at(m, F.lit("PRES")).try_cast("bigint").alias("pressure"),
        (F.try_element_at(m, F.lit("ACTIVE")) == "True").alias("active"),
    )


def parse_reading(c: Column) -> Column:
    """Number out of ``'PRESSURE_READING: 2750 MBAR'``."""
    return F.regexp_extract(F.upper(c), r":\s*(-?\d+)\s*MBAR", 1).try_cast("bigint")


def json_default(c: Column, path: str, default: Column) -> Column:
    return F.coalesce(F.get_json_object(c, path), default)


def links_of(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))


def kth_link(html: Column, k: int) -> Column:
    return F.try_element_at(links_of(html), F.lit(k))
