"""Operators: functions from DataFrame(s) to DataFrame."""
