"""Barograph: weather-observation analytics and regression on PySpark.

Everything is a function from DataFrame to DataFrame (or a fit/apply pair).
Actions happen only where a model is fitted, a table is written, or a function
says so in its docstring.
"""
