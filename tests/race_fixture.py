"""A small made-up race: landed records with every edge case, and its mart worked out row by row."""

from __future__ import annotations

import datetime
import json
from pathlib import Path

START = datetime.datetime(2024, 6, 1, 14, 0, tzinfo=datetime.UTC)
SESSIONS = (100, 200)
DRIVERS = (1, 2, 3, 4)
LAPS = range(1, 13)


def clock(seconds):
    return None if seconds is None else START + datetime.timedelta(seconds=seconds)


def iso(seconds):
    return None if seconds is None else clock(seconds).isoformat()


def lap_start(session, driver, lap):
    special = {
        (100, 1, 2): 91.0,  # 60 s after the observation at 31
        (100, 2, 2): 91.001,  # just above
        (100, 1, 3): 181.0,  # at the time of an observation
        (100, 3, 4): None,
        (100, 4, 5): 400.0,  # starts when the safety car period ends
        (100, 4, 8): 620.0,  # ends when the red flag comes
    }
    return special.get((session, driver, lap), (lap - 1) * 90 + driver * 2)


def lap_duration(session, driver, lap):
    special = {(100, 2, 5): None, (100, 4, 8): 80.0, (200, 1, 1): None}
    return special.get((session, driver, lap), 78 + driver * 1.5 + (lap % 5) * 0.25)


def laps():
    rows = []
    for session in SESSIONS:
        for driver in DRIVERS:
            for lap in LAPS:
                duration = lap_duration(session, driver, lap)
                rows.append(
                    {
                        "meeting_key": 1,
                        "session_key": session,
                        "driver_number": driver,
                        "lap_number": lap,
                        "date_start": iso(lap_start(session, driver, lap)),
                        "lap_duration": duration,
                        "duration_sector_1": None if duration is None else duration / 4,
                        "duration_sector_2": 30.5,
                        "duration_sector_3": None,
                        "is_pit_out_lap": {(2, 11): None, (1, 7): True}.get((driver, lap), False),
                        "segments": [1, 2],
                    }
                )
    return rows


def drivers():
    return [
        {
            "meeting_key": 1,
            "session_key": session,
            "driver_number": driver,
            "full_name": f"Driver {driver}",
            "name_acronym": f"DR{driver}",
            "team_name": "Team",
            "team_colour": "abcdef",
            "country_code": None if driver == 2 else "XYZ",
            "headshot_url": None,
        }
        for session in SESSIONS
        for driver in DRIVERS
        if (session, driver) != (200, 4)
    ]


def stints():
    bounds = {
        1: [(1, 6, "INTERMEDIATE"), (7, 12, "INTERMEDIATE")],  # new stint, same compound
        2: [(1, 6, "INTERMEDIATE"), (7, 9, "WET"), (10, 12, "INTERMEDIATE")],
        3: [(1, 5, "WET"), (None, None, "WET"), (8, 12, "INTERMEDIATE")],  # laps 6 and 7 in no known stint
        4: [(2, 12, "INTERMEDIATE"), (13, None, "WET")],
    }
    return [
        {
            "meeting_key": 1,
            "session_key": session,
            "driver_number": driver,
            "stint_number": number,
            "lap_start": low,
            "lap_end": high,
            "compound": compound,
            "tyre_age_at_start": number - 1,
        }
        for session in SESSIONS
        for driver in DRIVERS
        for number, (low, high, compound) in enumerate(bounds[driver], 1)
    ]


def pit_stops():
    stops = {(1, 6): 2.5, (2, 6): None, (2, 9): 3.1, (3, 7): None, (4, 12): 2.2}
    return [
        {
            "meeting_key": 1,
            "session_key": session,
            "driver_number": driver,
            "lap_number": lap,
            "date": iso((lap - 1) * 90 + 80),
            "lane_duration": 24.5 + driver,
            "pit_duration": 24.5 + driver,
            "stop_duration": stop,
        }
        for session in SESSIONS
        for (driver, lap), stop in stops.items()
        if (session, driver) != (200, 3)
    ]


def circuit_weather():
    times = {100: [31.0, 181.0, 240.0, 300.0, 420.0, 480.0, 700.0, 760.0, 900.0], 200: [5.0, 65.0, 500.0, 560.0]}
    return [
        {
            "meeting_key": 1,
            "session_key": session,
            "date": iso(time),
            "air_temperature": 20 + i / 4,
            "track_temperature": 25 + i / 2,
            "humidity": 80.0 + i,
            "pressure": 920.5,
            "wind_speed": 1.5 * i,
            "wind_direction": 10 * i,
            "rainfall": [0, 0, 1, 1, 0, 1, 1, 1, 0][i],
        }
        for session in SESSIONS
        for i, time in enumerate(times[session])
    ]


# (session, seconds, category, flag, message)
MESSAGES = [
    (100, 0, "Flag", "GREEN", "GREEN LIGHT - PIT EXIT OPEN"),
    (100, 1, "SessionStatus", None, "SESSION STARTED"),
    (100, 100, "SafetyCar", None, "VIRTUAL SAFETY CAR DEPLOYED"),
    (100, 120, "Flag", "CLEAR", "TRACK CLEAR"),  # not under the safety car: ignored
    (100, 150, "SafetyCar", None, "VIRTUAL SAFETY CAR ENDING"),
    (100, 300, "SafetyCar", None, "SAFETY CAR DEPLOYED"),
    (100, 350, "SafetyCar", None, "SAFETY CAR IN THIS LAP"),
    (100, 400, "Flag", "CLEAR", "TRACK CLEAR"),
    (100, 410, "Flag", "CLEAR", "TRACK CLEAR"),
    (100, 500, "Flag", "YELLOW", "YELLOW IN TRACK SECTOR 3"),
    (100, 700, "Flag", "RED", "RED FLAG"),
    (100, 710, "SessionStatus", None, "SESSION ABORTED"),
    (100, 800, "SessionStatus", None, "SESSION STARTED"),
    (100, 1100, "SessionStatus", None, "SESSION FINISHED"),
    # The second race never finishes.
    (200, 2, "SessionStatus", None, "SESSION STARTED"),
    (200, 600, "SafetyCar", None, "SAFETY CAR DEPLOYED"),
    (200, 650, "Drs", None, "DRS DISABLED"),
    (200, 660, "Flag", "CLEAR", "TRACK CLEAR"),
    (200, 900, "SafetyCar", None, "VIRTUAL SAFETY CAR DEPLOYED"),
]


def race_control():
    return [
        {
            "meeting_key": 1,
            "session_key": session,
            "date": iso(seconds),
            "lap_number": int(seconds // 90) + 1,
            "category": category,
            "flag": flag,
            "scope": "Track",
            "sector": None,
            "driver_number": None,
            "message": message,
        }
        for session, seconds, category, flag, message in MESSAGES
    ]


STATUS = [
    (100, 1, 100, "NORMAL", "SESSION STARTED"),
    (100, 100, 150, "VSC", "VIRTUAL SAFETY CAR DEPLOYED"),
    (100, 150, 300, "NORMAL", "VIRTUAL SAFETY CAR ENDING"),
    (100, 300, 400, "SAFETY_CAR", "SAFETY CAR DEPLOYED"),
    (100, 400, 700, "NORMAL", "TRACK CLEAR"),
    (100, 700, 800, "RED_FLAG", "RED FLAG"),
    (100, 800, 1100, "NORMAL", "SESSION STARTED"),
    (200, 2, 600, "NORMAL", "SESSION STARTED"),
    (200, 600, 660, "SAFETY_CAR", "SAFETY CAR DEPLOYED"),
    (200, 660, 900, "NORMAL", "TRACK CLEAR"),
]


def hourly_weather():
    return {
        "latitude": 1.5,
        "longitude": 2.5,
        "hourly": {
            "time": ["2024-06-01T13:00", "2024-06-01T14:00"],
            "temperature_2m": [20.5, 21.0],
            "relative_humidity_2m": [80, 82],
            "precipitation": [0.0, 0.5],
            "rain": [0.0, 0.5],
            "wind_speed_10m": [3.0, None],
        },
    }


def land(folder: Path) -> dict[str, str]:
    datasets = (drivers, laps, stints, pit_stops, circuit_weather, race_control, hourly_weather)
    paths = {}
    for dataset in datasets:
        path = folder / f"{dataset.__name__}.json"
        path.write_text(json.dumps(dataset(), indent=2))
        paths[dataset.__name__] = str(path)
    return paths


def expected_mart() -> dict[tuple[int, int, int], dict]:
    """The mart by nested loops over the records."""
    mart = {}
    for lap in laps():
        session, driver, number = lap["session_key"], lap["driver_number"], lap["lap_number"]
        start, duration = lap_start(session, driver, number), lap["lap_duration"]
        end = None if start is None or duration is None else start + duration

        seen = [
            (datetime.datetime.fromisoformat(w["date"]), w) for w in circuit_weather() if w["session_key"] == session
        ]
        seen = [(time, w) for time, w in seen if start is not None and time <= clock(start)]
        time, weather = max(seen, key=lambda pair: pair[0]) if seen else (None, None)
        gap = None if weather is None else (clock(start) - time).total_seconds()
        matching = [
            s
            for s in stints()
            if (s["session_key"], s["driver_number"]) == (session, driver)
            and s["lap_start"] is not None
            and s["lap_end"] is not None
            and s["lap_start"] <= number <= s["lap_end"]
        ]
        stint = matching[0] if matching else None
        pits = [p for p in pit_stops() if (p["session_key"], p["driver_number"], p["lap_number"]) == (session, driver, number)]
        neutralised = None
        if end is not None:
            neutralised = any(s == session and state != "NORMAL" and start < b and end > a for s, a, b, state, _ in STATUS)
        row = {
            "date_start": clock(start),
            "date_end": clock(end),
            "lap_duration": duration,
            "valid_for_weather": start is not None,
            "valid_for_pace": duration is not None,
            "full_name": None if (session, driver) == (200, 4) else f"Driver {driver}",
            "stint_number": stint and stint["stint_number"],
            "compound": stint and stint["compound"],
            "valid_for_strategy": True if stint else None,
            "pit_duration": pits[0]["pit_duration"] if pits else None,
            "valid_stop_duration": pits[0]["stop_duration"] is not None if pits else None,
            "is_pit_stop": bool(pits),
            "weather_time": time,
            "track_temperature": weather and weather["track_temperature"],
            "rainfall": None if weather is None else weather["rainfall"],
            "weather_time_gap": gap,
            "valid_weather_match": gap is not None and gap <= 60,
            "is_neutralised": neutralised,
        }
        row["valid_green_flag_pace"] = bool(
            row["valid_for_pace"]
            and row["valid_weather_match"]
            and not row["is_pit_stop"]
            and not lap["is_pit_out_lap"]
            and neutralised is False
        )
        row["is_pit_out_lap"] = lap["is_pit_out_lap"]
        mart[session, driver, number] = row
    return mart
