from shelfcast.functions.calendar import calendar_columns
from shelfcast.functions.text import city_from_path, city_key

__all__ = ["calendar_columns", "city_from_path", "city_key"]
