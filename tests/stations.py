"""Small snapshots for the tests."""

from __future__ import annotations

import copy
import json

POLLED = 1_772_000_000  # 2026-02-25 06:13:20 UTC


def snapshot(*stations: dict, polled: int = POLLED, version: str = "2.3") -> dict:
    """A snapshot of stations given as {"id", "status", "details"}."""
    return {
        "system_id": "harbour",
        "ingested_at": polled + 4,
        "station_information": {
            "version": version,
            "data": {"stations": [{"station_id": s["id"], **s["details"]} for s in stations]},
        },
        "station_status": {
            "version": version,
            "last_updated": polled,
            "ttl": 25,
            "data": {"stations": [{"station_id": s["id"], **s["status"]} for s in stations]},
        },
    }


def station(name: str, age: int = 35, bikes: int | None = 9, alias: int | None = None, on: int = 1):
    status = {
        "last_reported": POLLED - age,
        "num_docks_available": 5,
        "is_installed": on,
        "is_renting": on,
        "is_returning": on,
    }
    if bikes is not None:
        status["num_bikes_available"] = bikes
    if alias is not None:
        status["bikes_available"] = alias
    place = {"lat": 53.54, "lon": 9.98}
    return {"id": name, "status": status, "details": {"name": f"Station {name}", "capacity": 14, **place}}


def quays() -> dict:
    """Five stations, each usable under other policies: always, with the alias, with grace, with both,
    never."""
    return snapshot(
        station("quay"),
        station("mill", bikes=None, alias=6),
        station("gate", age=1_450),
        station("yard", age=1_010, bikes=None, alias=3),
        station("barn", age=400, bikes=2, on=0),
    )


def event(**changes) -> dict:
    """A good raw event; ``status__x`` and ``metadata__x`` change nested keys, ... deletes."""
    source = station("quay")
    base = {
        "schema_version": 1,
        "event_id": "e1",
        "system_id": "harbour",
        "station_id": "quay",
        "source_updated_at": POLLED,
        "ingested_at": POLLED + 4,
        "status": {"station_id": "quay", **source["status"]},
        "metadata": {"station_id": "quay", **source["details"]},
    }
    out = copy.deepcopy(base)
    for name, value in changes.items():
        *section, key = name.split("__")
        place = out[section[0]] if section else out
        if value is ...:
            place.pop(key, None)
        else:
            place[key] = value
    return out


def messages(spark, events, first: int = 0, partition: int = 0):
    """Topic records from events (or from raw text)."""
    rows = [
        (None, e if isinstance(e, str) else json.dumps(e), partition, first + i)
        for i, e in enumerate(events)
    ]
    return spark.createDataFrame(
        rows, "key string, value string, partition int, offset bigint"
    )
