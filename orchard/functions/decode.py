"""Code-to-text decoders and the description line of a report.

Unknown codes give NULL (``concat_ws`` then skips them); pass
``on_unknown='error'`` to raise instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: code tables of the reports -------------------------------
PAGE_CLASS = {0: "ephemeral", 1: "evergreen"}
SEASON = {1: "spring", 2: "summer", 3: "autumn", 4: "winter"}
HOLIDAY = {0: "non-holiday", 1: "holiday"}
WEEKDAY = {0: "Sunday", 1: "Monday", 2: "Tuesday", 3: "Wednesday",
           4: "Thursday", 5: "Friday", 6: "Saturday"}
WORKINGDAY = {0: "non-working day", 1: "working day"}
WEATHER = {1: "clear", 2: "cloudy", 3: "light rain", 4: "heavy rain"}
# Scale factors that undo the normalisation of the hourly weather columns.
TEMP_SCALE, FEELS_SCALE, HUMIDITY_SCALE, WIND_SCALE = 41, 50, 100, 67
# ------------------------------------------------------------------------------


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def decode(c: str | Column, table: dict, on_unknown: str = "null") -> Column:
    """Map an integer-valued column through a small code table."""
    c = _c(c)
    out = None
    for code, text in table.items():
        out = (F.when(c == F.lit(code), F.lit(text)) if out is None
               else out.when(c == F.lit(code), F.lit(text)))
    if on_unknown == "error":
        return out.otherwise(F.raise_error(F.concat(F.lit("unknown code: "),
                                                    c.cast("string"))))
    return out


def page_class(c, on_unknown="null"):
    return decode(c, PAGE_CLASS, on_unknown)


def season(c, on_unknown="null"):
    return decode(c, SEASON, on_unknown)


def holiday(c, on_unknown="null"):
    return decode(c, HOLIDAY, on_unknown)


def weekday(c, on_unknown="null"):
    return decode(c, WEEKDAY, on_unknown)


def workingday(c, on_unknown="null"):
    return decode(c, WORKINGDAY, on_unknown)


def weather(c, on_unknown="null"):
    return decode(c, WEATHER, on_unknown)


def denormalize(c: str | Column, scale: int) -> Column:
    """``(x * scale)`` truncated toward zero to an int."""
    return (_c(c) * F.lit(scale)).cast("int")


def hourly_description(season_c, month_c, hour_c, holiday_c, weekday_c,
                       workingday_c, weather_c, temp_c, feels_c, hum_c,
                       wind_c) -> Column:
    """Comma-joined description of one hourly row."""
    return F.concat_ws(
        ",",
        season(season_c),
        F.concat(_c(month_c).cast("int").cast("string"), F.lit(" month")),
        F.concat(_c(hour_c).cast("int").cast("string"), F.lit(" h")),
        holiday(holiday_c),
        weekday(weekday_c),
        workingday(workingday_c),
        weather(weather_c),
        F.concat(F.lit("temp "), denormalize(temp_c, TEMP_SCALE).cast("string")),
        F.concat(F.lit("feels "), denormalize(feels_c, FEELS_SCALE).cast("string")),
        F.concat(F.lit("humidity "), denormalize(hum_c, HUMIDITY_SCALE).cast("string")),
        F.concat(F.lit("wind "), denormalize(wind_c, WIND_SCALE).cast("string")),
    )
