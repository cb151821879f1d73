"""Schemas of the landed records."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


LONG, DOUBLE, STRING, BOOLEAN = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()

DRIVERS = _struct(
    meeting_key=LONG,
    session_key=LONG,
    driver_number=LONG,
    full_name=STRING,
    name_acronym=STRING,
    team_name=STRING,
    team_colour=STRING,
    country_code=STRING,
)

LAPS = _struct(
    meeting_key=LONG,
    session_key=LONG,
    driver_number=LONG,
    lap_number=LONG,
    date_start=STRING,
    lap_duration=DOUBLE,
    duration_sector_1=DOUBLE,
    duration_sector_2=DOUBLE,
    duration_sector_3=DOUBLE,
    is_pit_out_lap=BOOLEAN,
)

STINTS = _struct(
    meeting_key=LONG,
    session_key=LONG,
    driver_number=LONG,
    stint_number=LONG,
    lap_start=LONG,
    lap_end=LONG,
    compound=STRING,
    tyre_age_at_start=LONG,
)

PIT_STOPS = _struct(
    meeting_key=LONG,
    session_key=LONG,
    driver_number=LONG,
    lap_number=LONG,
    date=STRING,
    lane_duration=DOUBLE,
    pit_duration=DOUBLE,
    stop_duration=DOUBLE,
)

CIRCUIT_WEATHER = _struct(
    meeting_key=LONG,
    session_key=LONG,
    date=STRING,
    air_temperature=DOUBLE,
    track_temperature=DOUBLE,
    humidity=DOUBLE,
    pressure=DOUBLE,
    wind_speed=DOUBLE,
    wind_direction=LONG,
    rainfall=LONG,
)

RACE_CONTROL = _struct(
    meeting_key=LONG,
    session_key=LONG,
    date=STRING,
    lap_number=LONG,
    category=STRING,
    flag=STRING,
    scope=STRING,
    sector=LONG,
    driver_number=LONG,
    message=STRING,
)

HOURLY_WEATHER = _struct(
    latitude=DOUBLE,
    longitude=DOUBLE,
    utc_offset_seconds=LONG,
    timezone=STRING,
    elevation=DOUBLE,
    hourly=_struct(
        time=T.ArrayType(STRING),
        temperature_2m=T.ArrayType(DOUBLE),
        relative_humidity_2m=T.ArrayType(LONG),
        precipitation=T.ArrayType(DOUBLE),
        rain=T.ArrayType(DOUBLE),
        wind_speed_10m=T.ArrayType(DOUBLE),
    ),
)
