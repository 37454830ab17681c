"""Train types, time of day and the labels built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.carbon import is_plane


def service_code(*candidates: Column) -> Column:
    """First code that is present, else the empty text."""
    return F.coalesce(*candidates, F.lit(""))


def _by_pattern(code: Column, patterns: list[tuple[str, str]]) -> Column:
    code = F.upper(code)
    (pattern, label), *rest = patterns
    case = F.when(code.rlike(pattern), F.lit(label))
    for pattern, label in rest:
        case = case.when(code.rlike(pattern), F.lit(label))
    return case


def classify_timetable(code: Column, route_type: Column, strict: bool = False) -> Column:
    """Type of a timetable service; `strict` matches whole words only."""
    patterns = C.STRICT_SERVICE_PATTERNS if strict else C.SERVICE_PATTERNS
    return (
        _by_pattern(code, patterns)
        .when(route_type == C.NIGHT_ROUTE_TYPE, F.lit("Train Nuit"))
        .otherwise(F.lit("Train Longue Distance"))
    )


def classify_sheet(code: Column, sheet_type: Column, strict: bool = False) -> Column:
    """Type of a night-sheet service, whose own type is text."""
    patterns = C.STRICT_SERVICE_PATTERNS if strict else C.SERVICE_PATTERNS
    return (
        _by_pattern(code, [*patterns, C.NIGHT_SHEET_PATTERN])
        .when(sheet_type == F.lit(str(C.NIGHT_ROUTE_TYPE)), F.lit("Train Nuit"))
        .otherwise(F.lit("InterCity"))
    )


def hour_of(time_text: Column) -> Column:
    """Hour of `HH:MM:SS`; timetables go past 24 h, so this never becomes a timestamp."""
    return F.substring(time_text, 1, 2).try_cast("int")


def is_night(hour: Column, base_type: Column) -> Column:
    at_night = (hour >= C.FIRST_NIGHT_HOUR) | (hour <= C.LAST_NIGHT_HOUR)
    return F.coalesce(at_night, F.lit(False)) | base_type.isin(C.NIGHT_TYPES)


def final_type(base_type: Column, night: Column) -> Column:
    """The type with ' Nuit' appended to night trains that do not say so already."""
    return F.when(
        night & ~base_type.isin(C.NIGHT_TYPES), F.concat(base_type, F.lit(" Nuit"))
    ).otherwise(base_type)


def mode_of(vehicule_type: Column) -> Column:
    return F.when(is_plane(vehicule_type), F.lit("Avion")).otherwise(F.lit("Train"))


def day_or_night(vehicule_type: Column) -> Column:
    night = vehicule_type.isin(C.NIGHT_TYPES_DASHBOARD) | vehicule_type.contains("Nuit")
    return F.when(night, F.lit("Nuit")).when(~is_plane(vehicule_type), F.lit("Jour"))


def distance_category(is_long: Column, limit: str) -> Column:
    return F.when(is_long, F.lit(f"Longue distance (>{limit}km)")).when(
        ~is_long, F.lit(f"Courte distance (≤{limit}km)")
    )


def arrow(start: Column, end: Column) -> Column:
    return F.concat(start, F.lit(" → "), end)
