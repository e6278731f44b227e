"""Record layouts shared by sources, parsers and sinks."""

from __future__ import annotations

from typing import NamedTuple


class Signal(NamedTuple):
    column: str
    label: str


# Field order of a signal line, the file's column labels and the
# short column names of the typed form.
DATE_TIME = "Date/Time"
SIGNALS = (
    Signal("LV_ActivePower", "LV ActivePower (kW)"),
    Signal("Wind_Speed", "Wind Speed (m/s)"),
    Signal("Theoretical_Power_Curve", "Theoretical_Power_Curve (KWh)"),
    Signal("Wind_Direction", "Wind Direction (°)"),
)
POWER = SIGNALS[0].column

# How a date and time is written in a signal line. Readers also
# accept seconds, or no time at all.
WRITE_TIME_PATTERN = "dd MM yyyy HH:mm"
READ_TIME_PATTERN = "dd MM yyyy[ HH:mm[:ss]]"

# Target names of the hourly averages.
SIGNAL_MAPPING_JSON = """
[
  {"sig_name": "LV ActivePower (kW)", "sig_mapping_name": "active_power_average"},
  {"sig_name": "Wind Speed (m/s)", "sig_mapping_name": "wind_speed_average"},
  {"sig_name": "Theoretical_Power_Curve (KWh)", "sig_mapping_name": "theo_power_curve_average"},
  {"sig_name": "Wind Direction (°)", "sig_mapping_name": "wind_direction_average"}
]
"""
SIGNAL_MAPPING_DDL = "array<struct<sig_name string, sig_mapping_name string>>"

# Generation bands as (exclusive upper limit, name); the last one is open.
GENERATION_BANDS = ((200.0, "Low"), (600.0, "Medium"), (1000.0, "High"), (None, "Exceptional"))

TYPED_SIGNAL_DDL = "DateTime string, " + ", ".join(f"{s.column} double" for s in SIGNALS)
