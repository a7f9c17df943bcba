from stratalake.functions.calendar import calendar_columns, iso_weekday, semester, year_month
from stratalake.functions.money import line_total_gold, line_total_silver, order_total
from stratalake.functions.values import account_number, filled, full_name, random_uuid, stable_uuid

__all__ = [
    "account_number",
    "calendar_columns",
    "filled",
    "full_name",
    "iso_weekday",
    "line_total_gold",
    "line_total_silver",
    "order_total",
    "random_uuid",
    "semester",
    "stable_uuid",
    "year_month",
]
