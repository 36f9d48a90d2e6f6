"""gridflow: metering and order-event analytics as PySpark DataFrame transforms.

Every transform takes and returns DataFrames, so the same code runs on tables and on
streams. Readers and writers live apart from the transforms.
"""
