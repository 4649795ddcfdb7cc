"""Operators: functions from DataFrame to DataFrame that several reports share."""
