from odometrix.sources.catalog import MODELS, model_catalog, with_vehicle_type
from odometrix.sources.sensor_json import corrupt_sensor_records, read_indented_array, read_sensor_json
from odometrix.sources.spine import hourly_spine, hourly_spine_for
from odometrix.sources.tables import TABLES, load_table, register_tables
from odometrix.sources.writers import (
    path_exists,
    save_gold,
    write_once,
    write_overwrite,
    write_sensor_json,
)

__all__ = [
    "MODELS",
    "model_catalog",
    "with_vehicle_type",
    "TABLES",
    "corrupt_sensor_records",
    "hourly_spine",
    "hourly_spine_for",
    "load_table",
    "path_exists",
    "read_indented_array",
    "read_sensor_json",
    "register_tables",
    "save_gold",
    "write_once",
    "write_overwrite",
    "write_sensor_json",
]
