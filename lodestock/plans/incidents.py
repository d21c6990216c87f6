"""Incident notices from text to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import html_to_text, keyword_label

# Incident types by word in the title and by feed code.
TYPE_WORDS = [("Earthquake", "Earthquake"), ("Eruption", "Volcano"), ("Flood", "Flood")]
FEED_TYPES = {"EQ": "Earthquake", "FL": "Flood", "TC": "Tropical Cyclone", "VO": "Volcano", "WF": "Wildfire"}
TIME_FORMATS = ["hh:mm a z 'on' dd MMM yyyy", "hh:mm a z 'on' dd MMMM yyyy"]


def _after(body: Column, heading: str, pattern: str) -> Column:
    found = F.regexp_extract(body, rf"(?s)<h4[^>]*>[^<]*{heading}.*?</h4>.*?{pattern}", 1)
    return F.nullif(found, F.lit(""))


def _cell(body: Column, tag: str) -> Column:
    """Text after ``tag:`` in a table cell."""
    return F.nullif(F.regexp_extract(body, rf"(?s)<td[^>]*>\s*{tag}:\s*(.*?)\s*</td>", 1), F.lit(""))


def incident_fields(notices: DataFrame, key: str, body: str, ignored_links: Sequence[str] = ()) -> DataFrame:
    """Title, time, radius, probability, link, coordinates and type of each notice."""
    text = F.col(body)
    title = F.trim(html_to_text(_after(text, "Incident Details", r"<td[^>]*>(.*?)</td>")))
    when = F.coalesce(*[F.try_to_timestamp(_cell(text, "Time"), F.lit(f)) for f in TIME_FORMATS])
    outage = F.regexp_extract(_after(text, "Supplier Impact Prediction", r"<div[^>]*>(.*?)</div>"), r"(\d+(?:\.\d+)?)%", 1)
    link = _after(text, "News Links", r"<a [^>]*href[^>]*>(.*?)</a>")
    link = F.when(~link.isin(list(ignored_links)), link) if ignored_links else link
    place = F.regexp_extract(text, r"Lat/Lon:</td>\s*<td[^>]*>\s*(-?[\d.]+ , -?[\d.]+)", 1)
    point = F.split(F.nullif(place, F.lit("")), " , ")
    code = F.regexp_extract(text, r"GDACS ID</td>\s*<td[^>]*>\s*([A-Z]{2}) ", 1)
    # Found once each, then read several times: a second projection keeps the
    # patterns from being matched again for every use.
    found = notices.select(
        key,
        title.alias("incident"),
        when.alias("time"),
        _cell(text, "Impact radius").alias("impact_radius"),
        outage.alias("_outage"),
        link.alias("link"),
        point.alias("_point"),
        code.alias("_code"),
    )
    feed_type = F.try_element_at(F.create_map(*[F.lit(x) for kv in FEED_TYPES.items() for x in kv]), F.col("_code"))
    place = [F.round(F.get("_point", F.lit(i)).try_cast("double"), 4) for i in (0, 1)]
    return found.select(
        key,
        "incident",
        "time",
        "impact_radius",
        (F.col("_outage").try_cast("double") / 100).alias("outage_probability"),
        "link",
        place[0].alias("latitude"),
        place[1].alias("longitude"),
        F.coalesce(feed_type, keyword_label("incident", TYPE_WORDS)).alias("incident_type"),
    )
