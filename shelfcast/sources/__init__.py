from shelfcast.sources.csv import (
    RejectCounts,
    check_rejects,
    count_rejects,
    read_csv,
    read_csv_text,
    typed,
)
from shelfcast.sources.intake import Intake
from shelfcast.sources.jdbc import Database
from shelfcast.sources.weather import read_weather

__all__ = [
    "Database",
    "Intake",
    "RejectCounts",
    "check_rejects",
    "count_rejects",
    "read_csv",
    "read_csv_text",
    "read_weather",
    "typed",
]
