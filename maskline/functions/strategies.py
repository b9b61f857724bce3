"""Column strategies: suppress, generalise, shift dates, synthesise names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import keyed

# Three-digit ZIP areas of few people, which become 000; names of synthetic people.
RESTRICTED_ZIP3 = ("036", "059", "063", "102", "203", "556", "692", "790", "821", "823", "830", "831", "878", "879", "884", "890", "893")
FIRST_NAMES = ("Alex", "Jordan", "Taylor", "Morgan", "Casey", "Riley", "Jamie", "Avery", "Quinn", "Skyler", "Cameron", "Reese", "Rowan", "Sawyer", "Emerson", "Finley")
LAST_NAMES = ("Rivera", "Chen", "Patel", "Nguyen", "Kim", "Garcia", "Okafor", "Haddad", "Silva", "Novak", "Ivanov", "Costa", "Mbeki", "Andersson", "Rossi", "Dubois")


def suppress(redaction: str | None = None) -> Column:
    return F.lit(redaction).cast("string")


def coerce_date(value: Column) -> Column:
    """Date of a date, a timestamp, or text in one of three orders; anything else is null."""
    text = value.cast("string")
    tried = [F.try_to_timestamp(text, F.lit(p)).cast("date") for p in ("yyyy-M-d", "M/d/yyyy", "yyyy/M/d")]
    return F.coalesce(*tried)


def _as_date(value: Column, kind: str) -> Column:
    return value.cast("date") if kind in ("date", "timestamp", "timestamp_ntz") else coerce_date(value)


def year_of(value: Column, kind: str = "string") -> Column:
    return F.year(_as_date(value, kind))


def zip3(value: Column) -> Column:
    """First three digits; fewer digits, or a restricted area, give 000."""
    digits = F.regexp_replace(value.cast("string"), r"(?U)[^\d]", "")
    head = F.substring(digits, 1, 3)
    return keyed.unless_blank(value, F.when((F.length(digits) < 3) | head.isin(*RESTRICTED_ZIP3), "000").otherwise(head))


def age_cap(value: Column, kind: str = "string", cap: int = 90) -> Column:
    """Ages from the cap up become the cap; what is no whole number as text is null; a fraction is cut."""
    if kind == "string":
        text = F.trim(value)
        age = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    else:
        age = value.try_cast("int")
    return F.when(age.isNotNull(), F.least(age, F.lit(cap)))


def date_shift(value: Column, entity: Column, kind: str = "string", max_days: int = 365) -> Column:
    """Move a date by its entity's own number of days, -max to +max; gaps inside an entity stay.

    A date without an entity cannot be shifted and stops the query.
    """
    date = _as_date(value, kind)
    days = (keyed.digest_number(entity, "date_shift") % (2 * max_days + 1)).cast("int") - max_days
    known = F.when(entity.isNull(), F.raise_error(F.lit("a date to shift has no entity")).cast("int")).otherwise(days)
    return F.when(date.isNotNull(), F.date_add(date, known))


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (index % len(names) + 1).cast("int"))


def synthesize(value: Column, kind: str) -> Column:
    """A name that the value always gets: first_name, last_name, or name as "Last, First"."""
    n = keyed.digest_number(value, f"synth_{kind}")
    made = {
        "first_name": lambda: _pick(FIRST_NAMES, n),
        "last_name": lambda: _pick(LAST_NAMES, n),
        "name": lambda: F.concat(_pick(LAST_NAMES, F.floor(n / len(FIRST_NAMES))), F.lit(", "), _pick(FIRST_NAMES, n)),
    }
    return keyed.unless_blank(value, made[kind]())
