from odometrix.streaming.sensor_landing import land_sensor_stream

__all__ = ["land_sensor_stream"]
