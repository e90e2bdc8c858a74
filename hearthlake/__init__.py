"""Property-listing lakehouse jobs written with the PySpark DataFrame API.

Every public function takes DataFrames or Columns and returns a DataFrame or a
Column. Nothing collects rows to the driver and there are no Python UDFs.
"""
