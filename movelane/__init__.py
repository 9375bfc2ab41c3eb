"""movelane: a PySpark-native engine that turns short news items into a deduplicated event dataset.

Every operator is a function from DataFrames to DataFrames; nothing runs until the caller asks for rows.
"""
