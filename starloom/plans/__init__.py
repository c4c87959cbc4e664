from starloom.plans.catalog import load_catalog, recreate_star, star_tables
from starloom.plans.load import Sources, create_views, fan_out, labelled, read_table, run
from starloom.plans.lookups import load_lookups, stage_listens
from starloom.plans.profiles import LAKE, PROFILES, STAGED_INNER, STAGED_LEFT, UPSERT, Profile
from starloom.plans.star import build_catalogue, build_plays, build_songplays, build_time, build_users

__all__ = [
    "LAKE",
    "PROFILES",
    "STAGED_INNER",
    "STAGED_LEFT",
    "UPSERT",
    "Profile",
    "Sources",
    "build_catalogue",
    "build_plays",
    "build_songplays",
    "build_time",
    "build_users",
    "create_views",
    "fan_out",
    "labelled",
    "load_catalog",
    "load_lookups",
    "read_table",
    "recreate_star",
    "run",
    "stage_listens",
    "star_tables",
]
