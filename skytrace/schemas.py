"""Schemas of the inputs and the order of the output columns."""

from __future__ import annotations

from pyspark.sql import types as T

_NUMBER = T.DecimalType(18, 6)

PACKETS = T.StructType([
    T.StructField("tm", T.TimestampType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("speed_mph", _NUMBER),
    T.StructField("bearing", _NUMBER),
    T.StructField("altitude", _NUMBER),
    T.StructField("comment", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("raw", T.StringType()),
    T.StructField("ptype", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("channel", _NUMBER),
    T.StructField("frequency", _NUMBER),
])

# The only packet columns any operator reads.
PACKET_COLUMNS = [
    "tm", "callsign", "raw", "bearing", "speed_mph", "altitude", "latitude", "longitude",
]

FLIGHTS = T.StructType([
    T.StructField("flight", T.StringType()),
    T.StructField("beacons", T.ArrayType(T.StringType())),
    T.StructField("day", T.StringType()),
    T.StructField("balloonsize", T.StringType()),
    T.StructField("parachute", T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("size", T.StringType()),
    ])),
    T.StructField("weights", T.MapType(T.StringType(), T.StringType())),
    T.StructField("liftfactor", T.StringType()),
    T.StructField("h2fill", T.StringType()),
])

# Names and order of the published packet columns.
EXTRACTED_COLUMNS = [
    "info", "receivetime", "packettime", "callsign", "raw", "bearing", "speed_mph", "speed_kph",
    "altitude_ft", "altitude_m", "latitude", "longitude", "temperature_f", "temperature_c",
    "temperature_k", "pressure_atm", "pressure_pa",
]

OUTPUT_COLUMNS = [
    "flightid", "callsign", "receivetime", "packettime", "altitude_ft", "altitude_m",
    "vert_rate_ftmin", "elapsed_secs", "flight_phase", "position_packet", "info", "raw",
    "bearing", "speed_mph", "speed_kph", "latitude", "longitude", "distance_from_launch_mi",
    "distance_from_launch_km", "temperature_f", "temperature_c", "temperature_k", "pressure_pa",
    "pressure_atm", "airdensity_slugs", "airdensity_kgm3", "velocity_x_degs", "velocity_y_degs",
    "velocity_z_fts", "velocity_z_ms", "airflow", "acceleration_fts2", "velocity_mean_fts",
    "acceleration_mean_fts2", "velocity_std_fts", "acceleration_std_fts2", "velocity_norm_fts",
    "acceleration_norm_fts2", "velocity_curvefit_fts", "acceleration_ms2", "velocity_mean_ms",
    "acceleration_mean_ms2", "velocity_std_ms", "acceleration_std_ms2", "velocity_norm_ms",
    "acceleration_norm_ms2", "velocity_curvefit_ms",
]
TRAILING_COLUMNS = ["reynolds_transition"]
