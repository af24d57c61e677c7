"""Seeded payload files for the end-to-end tests."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

from gridtide.schemas import CITIES, FUELS, NEIGHBOURS, WEATHER_COLUMNS

START = dt.datetime(2024, 1, 10, 0, 0)
H = dt.timedelta(hours=1)


def run_time(run: int) -> dt.datetime:
    """Runs come every three hours, ten minutes past."""
    return START + 3 * run * H + dt.timedelta(minutes=10)


def _value(*key) -> int:
    return random.Random(repr(key)).randint(0, 500)


def power(zone: str, run: int) -> str:
    at = START + 3 * run * H
    history = []
    for back in range(24):
        t = at - back * H
        fresh = back < 3  # the newest hours are estimates that the next payloads revise
        gain = run if fresh else 0
        history.append({
            "zone": zone, "datetime": t.strftime("%Y-%m-%dT%H:00:00.000Z"), "isEstimated": fresh,
            "powerConsumptionBreakdown": {f: _value(zone, t, "c", f) + gain for f in FUELS},
            "powerProductionBreakdown": {f: _value(zone, t, "p", f) for f in FUELS if f != "nuclear"},
            "powerImportBreakdown": {n: _value(zone, t, "i", n) for n in NEIGHBOURS},
            "powerExportBreakdown": {n: _value(zone, t, "e", n) for n in NEIGHBOURS},
            "powerConsumptionTotal": _value(zone, t, "ct"), "powerProductionTotal": _value(zone, t, "pt"),
            "powerImportTotal": _value(zone, t, "it"), "powerExportTotal": _value(zone, t, "et"),
        })
    return json.dumps({"zone": zone, "history": history})


def carbon(zone: str, run: int) -> str:
    at = START + 3 * run * H
    return json.dumps({"zone": zone, "history": [
        {"zone": zone, "datetime": (at - b * H).strftime("%Y-%m-%dT%H:00:00.000Z"),
         "carbonIntensity": _value(zone, at - b * H, "carbon"), "isEstimated": b < 3}
        for b in range(24)
    ]})


def weather(city: str, run: int) -> str:
    local = START + 3 * run * H + 2 * H
    first = local.replace(hour=0) - 24 * H
    lines = [",".join(WEATHER_COLUMNS)]
    for i in range(96):
        t = first + i * H
        measures = [_value(city, t, m, run if t > local else 0) / 10 for m in WEATHER_COLUMNS[4:11]]
        lines.append(",".join([f'"{city}"', "38.0", "23.7", t.strftime("%Y-%m-%dT%H:%M:%S"), *map(str, measures), '"S1,S2"']))
    return "\r\n".join(lines) + "\r\n"


def land(base: str, run: int, zones=("GR",)) -> dict[str, str]:
    """Write the payload files of one run; returns the folder of each feed."""
    folders = {feed: os.path.join(base, f"run{run}", feed) for feed in ("power", "carbon", "weather")}

    def put(folder, name, text):
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(text)

    for z in zones:
        put(folders["power"], f"{z}.json", power(z, run))
        put(folders["carbon"], f"{z}.json", carbon(z, run))
    for c in (*CITIES, "Patras, Greece"):
        put(os.path.join(folders["weather"], f"location_name={c}"), "payload.csv", weather(c, run))
    return folders
