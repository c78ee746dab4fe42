"""Declared table schemas, and the column names found in older day files."""

from __future__ import annotations

from pyspark.sql.types import StructType

JOURNEYS = """
    operating_day date, journey_no string, destination string,
    has_realtime boolean, ever_reported boolean, operator string,
    line_id string, line_id_short string, line_short string,
    reported_cancelled boolean, journey_cancelled boolean,
    ts_reported_cancelled string, cancelled_any boolean,
    device_id string, client_id string, rt_type string,
    start_time string, start_station string, start_station_id string,
    end_time string, end_station string, end_station_id string
"""

# Journeys run in addition to the timetable share the columns of journeys.
EXTRAS = JOURNEYS

STOP_EVENTS = """
    operating_day date, operator string, device_id string, line_short string,
    line_id string, line_id_short string, journey_no string, idx int,
    has_rt boolean, sched_dep timestamp_ntz, sched_arr timestamp_ntz,
    dep_delay double, arr_delay double, station_no string, station_name string,
    lat double, lon double, cancelled boolean, additional boolean,
    ts_reported_cancelled string, reported_cancelled boolean
"""

DELAY_REPORTS = """
    operating_day date, operator string, line_short string, line_id string,
    journey_no string, sched_dep string, station_no int,
    delay_arrival double, delay_departure double, stop_cancelled boolean,
    reported_at string, station_name string
"""

# Journeys of a delivery counted by day and line; flags hold the number of journeys that have them.
JOURNEY_COUNTS = """
    operating_day date, line_id_short string, line_short string,
    total bigint, has_realtime bigint, ever_reported bigint
"""

STATIONS = "station_no string, lat double, lon double, station_name string"

LINES = "line string, bundle string, tier string, line_id_short string, id string"

PUBLICATION_TARGETS = "slug string, project_url string, folder_id int"

TABLES = {
    "journeys": JOURNEYS,
    "journey_counts": JOURNEY_COUNTS,
    "extras": EXTRAS,
    "stop_events": STOP_EVENTS,
    "delay_reports": DELAY_REPORTS,
    "stations": STATIONS,
    "lines": LINES,
    "publication_targets": PUBLICATION_TARGETS,
}


def struct(table: str) -> StructType:
    """Schema of a table; parsing it needs a running session."""
    return StructType.fromDDL(TABLES[table])


# Column names in files and master tables written by older tools.
_OLD_JOURNEYS = {
    "datum": "operating_day",
    "fnr": "journey_no",
    "destination": "destination",
    "hasRealtime": "has_realtime",
    "realtimeHasEverBeenReported": "ever_reported",
    "vu": "operator",
    "lineid": "line_id",
    "lineid_short": "line_id_short",
    "lineshort": "line_short",
    "reported_cancelled": "reported_cancelled",
    "journey_cancelled": "journey_cancelled",
    "ts_reported_cancelled": "ts_reported_cancelled",
    "cancelled_kum": "cancelled_any",
    "deviceid": "device_id",
    "clientid": "client_id",
    "journeyrttype": "rt_type",
    "fahrtstarttime": "start_time",
    "fahrtstartstationname": "start_station",
    "fahrtstartstationdhid": "start_station_id",
    "fahrtendtime": "end_time",
    "fahrtendstationname": "end_station",
    "fahrtendstationdhid": "end_station_id",
}
OLD_NAMES = {
    "journeys": _OLD_JOURNEYS,
    "extras": _OLD_JOURNEYS,
    "stop_events": {
        "operday": "operating_day",
        "journeyOperator": "operator",
        "deviceid": "device_id",
        "lineshortname": "line_short",
        "ex_lineid": "line_id",
        "lineid_short": "line_id_short",
        "fnr": "journey_no",
        "index": "idx",
        "has_rt": "has_rt",
        "dschedtime": "sched_dep",
        "aschedtime": "sched_arr",
        "dep_del": "dep_delay",
        "arr_del": "arr_delay",
        "station_nr": "station_no",
        "station_name": "station_name",
        "lat": "lat",
        "lon": "lon",
        "canc": "cancelled",
        "additional": "additional",
        "ts_reported_cancelled": "ts_reported_cancelled",
        "reported_cancelled": "reported_cancelled",
    },
    "delay_reports": {
        "operatingDay": "operating_day",
        "journeyOperator": "operator",
        "lineShortName": "line_short",
        "externalLineId": "line_id",
        "journeyID": "journey_no",
        "scheduleDeparture": "sched_dep",
        "stationExternalNumber": "station_no",
        "delay_minutes_arrival": "delay_arrival",
        "delay_minutes_departure": "delay_departure",
        "stop_cancelled": "stop_cancelled",
        "timestamp": "reported_at",
        "stationName": "station_name",
    },
    "lines": {
        "linie": "line",
        "buendel": "bundle",
        "ebene": "tier",
        "dlid": "line_id_short",
        "id": "id",
    },
    "publication_targets": {
        "buen": "slug",
        "project_url": "project_url",
        "folder_id": "folder_id",
    },
}
