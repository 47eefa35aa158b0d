"""odometrix: fleet-telemetry analytics as lazy PySpark DataFrame operators.

Subpackages:

* ``functions``  -- scalar column rules (built-in expressions only);
* ``operators``  -- DataFrame -> DataFrame operators: reports, deviation
  profiles and peak flags, tag rules and range faults, running totals;
* ``sources``    -- readers (parquet tables, the JSON sensor drop, the hourly
  spine, the model catalogue) and writers;
* ``plans``      -- the operators composed: the fleet raw -> silver -> gold
  tables, and the mapping onto the driver's tables with its oracle SQL;
* ``streaming``  -- incremental landing of the sensor file drop.

Every operator takes DataFrames and column names and returns a DataFrame.
Nothing here runs an action except the writers in ``odometrix.sources``.
"""

__version__ = "0.1.0"
