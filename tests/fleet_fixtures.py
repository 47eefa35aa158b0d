"""Hand-made fleet rows (schemas of FIXTURES.md)."""

import datetime as dt

META_SCHEMA = "vehicle_id string, make string, model string, vehicle_type string"
LOG_SCHEMA = "vehicle_id string, date date, type string, action_taken string, cost double"
SENSOR_SCHEMA = (
    "vehicle_id string, timestamp timestamp, mileage double, engine_temp double, "
    "oil_pressure double, battery_voltage double, front_left_tire_pressure double, "
    "front_right_tire_pressure double, rear_left_tire_pressure double, "
    "rear_right_tire_pressure double"
)

D = dt.date(2024, 3, 1)


def meta(spark):
    return spark.createDataFrame(
        [
            ("V00001", "Audi", "AE24", "Bus"),
            ("V00002", "Audi", "AE24", "Bus"),
            ("V00003", "Toyota", "Pilaris", "Van"),
            ("V00004", None, "S900", "Bus"),  # null make
            ("V00005", "Toyota", "Ero-200", "Bus"),  # no logs at all
            ("V00006", "Audi", "A700", "Van"),  # only planned logs
        ],
        META_SCHEMA,
    )


def logs(spark):
    return spark.createDataFrame(
        [
            ("V00001", D, "Reactive", "Repair", 100.0),
            ("V00001", D, "Reactive", "Inspection", 50.0),
            ("V00001", D, "Planned", "Replacement", 70.0),
            ("V00002", D, "Reactive", "Replacement", 80.0),
            ("V00003", D, "Reactive", "Repair", 90.0),
            ("V00004", D, "Reactive", "Repair", 60.0),
            ("V00006", D, "Planned", "Inspection", 55.0),
            ("V00009", D, "Reactive", "Repair", 10.0),  # vehicle not in metadata
        ],
        LOG_SCHEMA,
    )


def sensor_row(vid, hour, mileage, temp=85.0, oil=40.0, volt=13.0, tires=(32.0, 32.0, 32.0, 32.0)):
    ts = dt.datetime(2024, 3, 1) + dt.timedelta(hours=hour)
    return (vid, ts, mileage, temp, oil, volt, *tires)
