from lakestrata.sources.concat import concat_by_name
from lakestrata.sources.files import list_files, name_collisions
from lakestrata.sources.footers import file_schemas
from lakestrata.sources.inference import stage_delimited
from lakestrata.sources.landing import land_recursive
from lakestrata.sources.layers import preview, read_delimited, read_layer
from lakestrata.sources.routing import name_year, read_route, route_by_filename

__all__ = [
    "concat_by_name",
    "file_schemas",
    "land_recursive",
    "list_files",
    "name_collisions",
    "name_year",
    "preview",
    "read_delimited",
    "read_layer",
    "read_route",
    "route_by_filename",
    "stage_delimited",
]
