from civicflow.functions.geo import haversine_m, flat_earth_m  # noqa: F401
from civicflow.functions.jsonio import parse_records, to_json_value  # noqa: F401
