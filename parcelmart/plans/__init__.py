"""Mart plans: functions ``(tables, as_of) -> DataFrame``."""
