"""Flights written as short lines, for tests.

    HA/118 HNL-OGG 2021-07-04 out=0715 dep=3 arr=-8 weather=40

Carrier/number, route and date come first, in any order; measures follow as ``name=value``.
What a line leaves out is null, so a test shows exactly the cells it depends on.
"""

import re

from tarmac import schema as S

MEASURES = {
    "dep": "DepDelay",
    "arr": "ArrDelay",
    "off": "Cancelled",
    "why": "CancellationCode",
    "carrier": "CarrierDelay",
    "weather": "WeatherDelay",
    "nas": "NASDelay",
    "security": "SecurityDelay",
    "late": "LateAircraftDelay",
    "elapsed": "ActualElapsedTime",
    "miles": "Distance",
    "out": "DepTime",
    "in": "ArrTime",
}


def flight(line: str) -> dict:
    """One raw row, all 18 columns."""
    row = dict.fromkeys(S.RAW_COLUMNS)
    for word in line.split():
        if "=" in word:
            name, value = word.split("=", 1)
            row[MEASURES[name]] = value
        elif "/" in word:
            row["Reporting_Airline"], row["Flight_Number_Reporting_Airline"] = (part or None for part in word.split("/"))
        elif re.match(r"[0-9]", word):
            row["FlightDate"] = word
        else:
            row["Origin"], row["Dest"] = (part or None for part in word.split("-"))
    return row


def raw_frame(spark, lines):
    rows = [flight(line) for line in lines]
    return spark.createDataFrame([tuple(r[c] for c in S.RAW_COLUMNS) for r in rows], S.RAW_SCHEMA)


def write_csv(path, lines, columns=None, tail=""):
    """A raw CSV file with the given header; ``tail`` ends every data line (say, a comma)."""
    columns = columns or S.RAW_COLUMNS
    with open(path, "w") as out:
        out.write(",".join(columns) + "\n")
        for row in map(flight, lines):
            out.write(",".join(row.get(c) or "" for c in columns) + tail + "\n")
    return str(path)
