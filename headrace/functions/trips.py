"""Seeded synthetic trips: 25 text fields per row, drawn from the row's own key.

A draw depends on seed and key only. A retried task, another partitioning or a restarted stream
gives the same trips again, which ``rand`` does not promise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.functions import envelope

# The stream's field order, code sets and ranges.
FIELDS = [
    "hvfhs_license_num",
    "dispatching_base_num",
    "originating_base_num",
    "request_datetime",
    "on_scene_datetime",
    "pickup_datetime",
    "dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_miles",
    "trip_time",
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
    "tips",
    "driver_pay",
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
    "cbd_congestion_fee",
]
CODES = {
    "hvfhs_license_num": ["HV0003", "HV0005"],
    "dispatching_base_num": ["B03404", "B03406", "B03405"],
    "originating_base_num": ["B03404", "B03406", "B03405"],
    "tolls": ["0", "1", "2", "3", "4", "5"],
    "airport_fee": ["0", "1", "2"],
    "shared_request_flag": ["Y", "N"],
    "shared_match_flag": ["Y", "N"],
    "access_a_ride_flag": ["Y", "N"],
    "wav_request_flag": ["Y", "N"],
    "wav_match_flag": ["Y", "N"],
    "cbd_congestion_fee": ["0.0", "1.5", "3.0", "4.5"],
}
RANGES = {
    "bcf": ("0", "5.45"),
    "sales_tax": ("0.7", "15.68"),
    "congestion_surcharge": ("0", "2.75"),
    "tips": ("0", "8.48"),
}
OTHER_RANGE = ("1.141", "700")
DATETIMES = ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime"]
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

ENVELOPE_NAME = "nyc.taxi-record"
MILLION = 1_000_000
DRAWS_PER_HASH = 4


def _micros(text: str) -> int:
    return round(float(text) * MILLION)


def _draw(seed: int, key: Column, n: int) -> Column:
    """The n-th 32-bit draw of a row; four draws share one hash."""
    block, place = divmod(n, DRAWS_PER_HASH)
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), key.cast("string"), F.lit(str(block))))
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("bigint")


def _pick(draw: Column, codes: list[str]) -> Column:
    options = F.array(*(F.lit(code) for code in codes))
    return F.element_at(options, (draw % len(codes) + 1).cast("int"))


def _uniform(draw: Column, low: str, high: str) -> Column:
    """Uniform in [low, high) as text with six decimals, in whole-number arithmetic throughout."""
    width = F.lit(_micros(high) - _micros(low)).cast("bigint")
    micros = F.shiftright(draw * width, 32) + F.lit(_micros(low))
    whole = F.floor(micros / F.lit(MILLION)).cast("string")
    return F.concat(whole, F.lit("."), F.lpad((micros % MILLION).cast("string"), 6, "0"))


def trips(rows: DataFrame, key: str, time: str, seed: int = 0) -> DataFrame:
    """One trip per input row, from a table or a stream with a unique key and a timestamp."""
    stamp = F.date_format(time, DATETIME_FORMAT)
    drawn = [name for name in FIELDS if name not in DATETIMES]
    columns = {name: stamp for name in DATETIMES}
    for n, name in enumerate(drawn):
        draw = _draw(seed, F.col(key), n)
        if name in CODES:
            columns[name] = _pick(draw, CODES[name])
        else:
            columns[name] = _uniform(draw, *RANGES.get(name, OTHER_RANGE))
    return rows.select(*(columns[name].alias(name) for name in FIELDS))


def messages(rows: DataFrame, key: str, time: str, seed: int = 0) -> DataFrame:
    """The same trips as stream messages."""
    return envelope.encode(trips(rows, key, time, seed), ENVELOPE_NAME)
