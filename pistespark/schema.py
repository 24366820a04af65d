"""The schemas that all parts of the library agree on."""

VERTEX = "struct<lat:double,lon:double>"
RING = f"array<{VERTEX}>"
BOUNDS = "struct<minlat:double,minlon:double,maxlat:double,maxlon:double>"
MEMBERS = f"array<struct<type:string,ref:bigint,role:string,geometry:{RING}>>"
#: One map element: a node, way or relation. ordinal is its place in the input; results that depend on order use it.
ELEMENT = f"osm_type string, osm_id bigint, ordinal bigint, layer string, tags map<string,string>, geometry {RING}, lat double, lon double, bounds {BOUNDS}, members {MEMBERS}, nodes array<bigint>"
#: A feature near an area.
NEARBY = f"{ELEMENT}, winter_sports_id bigint, winter_sports_type string, winter_sports_name string, country string, state string, ski_area string"
#: The columns of the per-area table, in order.
DIFFICULTIES = ["novice", "easy", "intermediate", "advanced", "expert", "freeride", "extreme"]
ANALYZED = [
    *["winter_sports_id bigint", "winter_sports_type string", "name string", "country string", "state string", "centroid_lat double", "centroid_lon double"],
    *["total_area_ha double", "total_area_acres double", "skiable_terrain_ha double", "skiable_terrain_acres double"],
    *["total_lifts bigint", "longest_lift_mi double", "downhill_trails bigint", "longest_trail_mi double", "avg_trail_mi double"],
    *[f"trails_{d} bigint" for d in DIFFICULTIES],
    *["gladed_terrain string", "snow_park string", "sledding_tubing string", "lift_types string", "resort_type string"],
]
ANALYZED_COLUMNS = [c.split()[0] for c in ANALYZED]
ANALYZED_DDL = ", ".join(ANALYZED)
