"""Date, arithmetic and record scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.schemas import MEDIA, WEATHER

# Allowed arithmetic expression, and the weather report layout.
EXPRESSION_PATTERN = r"^[0-9+\-*/().\s]+$"


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def weekday(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def clock12(ts: Column) -> Column:
    return F.date_format(ts, "hh:mm a")


def shift_days(ts: Column, days: Column | int) -> Column:
    return F.date_add(F.to_date(ts), days)


def add(a: Column, b: Column) -> Column:
    return F.try_add(a, b)


def multiply(a: Column, b: Column) -> Column:
    return F.try_multiply(a, b)


def square_root(x: Column) -> Column:
    """NaN for negative input."""
    return F.sqrt(x)


def expression_allowed(c: Column) -> Column:
    """Verdict only: does the text consist of arithmetic characters?"""
    return c.rlike(EXPRESSION_PATTERN)


def parse_weather(payload: Column) -> Column:
    """The answer's JSON as a struct. Keep it as a column of its own: one parse per row."""
    return F.from_json(payload, WEATHER)


def weather_report(place: Column, answer: Column, units: Column) -> Column:
    """Report text from a parsed answer, or the error line when its status is not 200."""
    ok = F.concat(
        F.lit("Weather in "), place,
        F.lit(":\nCondition: "), F.get(answer["weather"], F.lit(0))["description"],
        F.lit("\nTemperature: "), answer["main"]["temp"],
        F.lit("°"), F.when(units == "metric", "C").otherwise("F"),
        F.lit("\nHumidity: "), answer["main"]["humidity"],
        F.lit("%\nWind Speed: "), answer["wind"]["speed"], F.lit(" m/s"),
    )
    failed = F.concat(F.lit("Error getting weather data: "), F.coalesce(answer["message"], F.lit("Unknown error")))
    return F.when(answer["status"] == 200, ok).otherwise(failed)


def rational(c: Column) -> Column:
    """`n/d` as a double; NULL when the denominator is zero or the text is no ratio."""
    num = F.substring_index(c, "/", 1).try_cast("double")
    den = F.when(F.contains(c, F.lit("/")), F.substring_index(c, "/", -1).try_cast("double")).otherwise(F.lit(1.0))
    return F.try_divide(num, den)


def parse_media(payload: Column) -> Column:
    """A probe's JSON as a struct. Keep it as a column of its own: one parse per row."""
    return F.from_json(payload, MEDIA)


def media_record(rec: Column) -> Column:
    """Normalised struct from a parsed probe, with a default for every absent field."""
    stream = F.get(rec["streams"], F.lit(0))
    fmt = rec["format"]

    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit("N/A"))

    width = F.coalesce(stream["width"], F.lit(0))
    height = F.coalesce(stream["height"], F.lit(0))
    return F.struct(
        text(stream["codec_name"]).alias("codec"),
        text(fmt["format_name"]).alias("format_name"),
        F.concat(width.cast("string"), F.lit("x"), height.cast("string")).alias("resolution"),
        F.coalesce(fmt["duration"].try_cast("double"), F.lit(0.0)).alias("duration"),
        rational(F.coalesce(stream["r_frame_rate"], F.lit("0/1"))).alias("fps"),
        text(stream["sample_aspect_ratio"]).alias("par"),
        text(stream["color_space"]).alias("colorspace"),
        text(stream["display_aspect_ratio"]).alias("aspect_ratio"),
    )


def slide_element(content: Column, depth: Column, page: Column, category: Column) -> Column:
    """Nested element; an absent depth stays an explicit NULL."""
    return F.struct(
        content.alias("content"),
        F.struct(
            depth.alias("category_depth"), page.alias("page_number"), category.alias("category")
        ).alias("metadata"),
    )
