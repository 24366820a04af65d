"""Tags, ids and names as Column expressions. Blank stands for missing throughout, and bad input gives null, not an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Aerialway values that are lifts (stations and pylons are not), and properties that are no tags.
LIFT_TYPES = ["chair_lift", "gondola", "cable_car", "drag_lift", "t-bar", "j-bar", "platter", "magic_carpet", "rope_tow", "mixed_lift"]
NOT_TAGS = ["osm_id", "osm_way_id", "id", "name", "other_tags"]
#: Properties that hold a country's and a state's name, best first.
COUNTRY_NAMES = ["ADMIN", "NAME", "NAME_LONG", "SOVEREIGNT"]
STATE_NAMES = ["name", "NAME", "NAME_1", "admin", "ADMIN1"]
DEFAULT_WIDTH_M = 30.0


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def first_of(*cols: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def first_id(*cols: Column) -> Column:
    """The first id that is neither null nor 0."""
    return F.coalesce(*[F.nullif(c.cast("bigint"), F.lit(0).cast("bigint")) for c in cols])


def clean_name(x: Column) -> Column:
    """Trimmed; null for blank and for the text nan in any case."""
    t = F.trim(x.cast("string"))
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def pick_name(props: Column, keys: list[str]) -> Column:
    """The first usable name in a map, by key."""
    return F.coalesce(*[clean_name(props[k]) for k in keys])


def text_id(x: Column) -> Column:
    """An id from text; 0 if it is not a whole number."""
    return F.coalesce(F.when(x.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), F.trim(x.cast("string")).try_cast("bigint")), F.lit(0).cast("bigint"))


def numeric_key(x: Column) -> Column:
    """A key from text or a number, also one with a decimal part (cut off); null if it is no number."""
    d = x.cast("string").try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.cast("bigint"))


def width(x: Column) -> Column:
    """A trail's width in metres; the default if it is missing or no plain number."""
    d = x.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d), d).otherwise(F.lit(DEFAULT_WIDTH_M))


def label(x: Column) -> Column:
    return F.replace(x, F.lit("_"), F.lit(" "))


def display_name(tags: Column, kind: Column, id_: Column) -> Column:
    return F.coalesce(blank_to_null(tags["name:en"]), blank_to_null(tags["name"]), F.concat_ws("/", kind, id_.cast("string")))


def difficulty(x: Column) -> Column:
    return F.lower(F.trim(F.coalesce(x, F.lit(""))))


def _last_wins(entries: Column) -> Column:
    """A map from an array of (key, value) whose keys may repeat."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"))))


def hstore(text: Column) -> Column:
    """``"k"=>"v","k2"=>"v2"`` as a map; the last of repeated keys wins; a comma inside a value stays."""
    pairs = F.transform(F.split(text, r'"\s*,\s*"'), lambda p: F.split(F.replace(p, F.lit('"'), F.lit("")), "=>", 2))
    entries = F.transform(F.filter(pairs, lambda p: F.size(p) == 2), lambda p: F.struct(F.trim(F.get(p, F.lit(0))).alias("key"), F.trim(F.get(p, F.lit(1))).alias("value")))
    return _last_wins(F.coalesce(F.filter(entries, lambda e: e["key"] != ""), F.array().cast("array<struct<key:string,value:string>>")))


def json_tags(text: Column) -> Column:
    """A JSON object as a map of strings; empty if it is missing or broken."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.coalesce(F.from_json(text, "map<string,string>"), empty)


def other_tags(text: Column) -> Column:
    return F.when(F.trim(text).startswith("{"), json_tags(text)).otherwise(hstore(text))


def tags_of(props: Column) -> Column:
    """Tags of a feature: its other_tags, under its own properties that are neither ids, geometry (any key that holds the word) nor
    blank. A name stays unless it is empty."""
    own = F.map_filter(props, lambda k, v: v.isNotNull() & (((k == "name") & (v != "")) | (~k.isin(NOT_TAGS) & ~F.lower(k).contains("geometry") & (F.trim(v) != ""))))
    more = F.map_filter(other_tags(F.coalesce(props["other_tags"], F.lit(""))), lambda k, v: ~F.array_contains(F.map_keys(own), k))
    return F.map_concat(own, more)


def tags_text(tags: Column) -> Column:
    """JSON of tags; null if there are none."""
    return F.when(F.size(tags) > 0, F.to_json(tags))
