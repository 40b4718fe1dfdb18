"""Spark DataFrame operators for hourly weather and electricity-demand analytics."""
