"""The analytics products: functions from DataFrames to one lazy DataFrame."""
