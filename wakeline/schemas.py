"""Explicit schemas. Nothing in this package infers a schema from data."""

# Raw AIS message as delivered by the feed. `_corrupt_record` receives the text
# of messages that do not parse.
RAW_AIS = """
    MessageType STRING,
    MetaData STRUCT<ShipName: STRING, MMSI: BIGINT>,
    Message STRUCT<
        PositionReport: STRUCT<
            UserID: BIGINT, Latitude: DOUBLE, Longitude: DOUBLE, Sog: DOUBLE,
            TrueHeading: DOUBLE, NavigationalStatus: INT>,
        StandardClassBPositionReport: STRUCT<
            UserID: BIGINT, Latitude: DOUBLE, Longitude: DOUBLE, Sog: DOUBLE,
            Cog: DOUBLE, TrueHeading: DOUBLE>>,
    _corrupt_record STRING
"""

# Flat position event on the wire: `timestamp` is ISO-8601 text, as JSON has no time type.
WIRE_EVENT = (
    "mmsi INT, ship_name STRING, lat DOUBLE, lon DOUBLE, speed DOUBLE, "
    "heading DOUBLE, status STRING, timestamp STRING"
)

# The same event once typed.
POSITION = (
    "mmsi INT, ship_name STRING, lat DOUBLE, lon DOUBLE, speed DOUBLE, "
    "heading DOUBLE, status STRING, timestamp TIMESTAMP"
)
POSITION_COLUMNS = ("mmsi", "ship_name", "lat", "lon", "speed", "heading", "status", "timestamp")

# Lake table: typed event + geofence flag + audit time, partitioned by `date`.
LAKE = POSITION + ", in_port BOOLEAN, ingestion_time TIMESTAMP, date DATE"
LAKE_COLUMNS = (*POSITION_COLUMNS, "in_port", "ingestion_time", "date")

# With the fields that the schema does not foresee.
LAKE_WITH_EXTRA = LAKE + ", extra VARIANT"

TEXT = "value STRING"

# Columns of the outputs, in order. The vessel key, where a report has one, is
# the first of each.
SNAPSHOT_COLUMNS = ("lat", "lon", "speed", "heading", "status", "in_port", "timestamp")
OPERATIONAL_COLUMNS = (
    "speed", "heading", "status_category", "distance_to_port_km", "age_sec", "time_display",
)
TOP_SPEED_COLUMNS = ("speed", "distance_to_port_km", "status_category")
STALEST_COLUMNS = ("age_sec", "time_display", "status_category", "distance_to_port_km")
