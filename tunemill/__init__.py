"""Music-listening analytics as plain PySpark jobs.

Every operator is a ``DataFrame -> DataFrame`` function. Nothing here holds a
session of its own, and nothing collects data to the driver.
"""
