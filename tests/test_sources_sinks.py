"""Landed-file sources, sinks and the incremental (streaming) loader."""

from __future__ import annotations

import datetime as dt
import json
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.config import YELLOW, TripRules
from strata.schemas import SchemaMismatchError
from strata.sinks import writers
from strata.sources import files, payloads
from strata.streaming.landing import load_new_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_zone_csv_header_no_quoting(spark, tmp):
    p = os.path.join(tmp, "zones.csv")
    _write(p, 'LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,"Jamaica Bay,Boro Zone\n')
    rows = payloads.read_csv(spark, p, payloads.ZONE_CSV).orderBy("LocationID").collect()
    assert rows[0].LocationID == 1 and rows[0].Zone == "Newark Airport"
    # quotes are plain text: the comma inside splits the field
    assert rows[1].Zone == '"Jamaica Bay' and rows[1].service_zone == "Boro Zone"


def test_fx_csv_32_columns(spark, tmp):
    names = [f.name for f in payloads.FX_CSV.fields]
    assert len(names) == 32
    vals = {n: "" for n in names}
    vals.update({"CURRENCY": "USD", "CURRENCY_DENOM": "EUR", "TIME_PERIOD": "2020-01-02", "OBS_VALUE": "1.1215", "DECIMALS": "4", "UNIT_MULT": "0", "TIME_FORMAT": "P1D"})
    line = ",".join(vals[n] for n in names)
    empty = line.replace("1.1215", "")
    p = os.path.join(tmp, "fx.csv")
    _write(p, ",".join(names) + "\n" + line + "\n" + empty + "\n")
    rows = payloads.read_csv(spark, p, payloads.FX_CSV).collect()
    assert rows[0].TIME_PERIOD == dt.date(2020, 1, 2) and rows[0].OBS_VALUE == 1.1215 and rows[0].DECIMALS == 4
    assert rows[1].OBS_VALUE is None


def test_gdp_json_documents(spark, tmp):
    def doc(code):
        recs = [
            {"indicator": {"id": "X", "value": "GDP"}, "country": {"id": "U", "value": "U"}, "countryiso3code": code, "date": str(y), "value": v, "unit": "", "obs_status": "", "decimal": 0}
            for y, v in ((2020, 1.5e12), (2021, None))
        ]
        return json.dumps([{"page": 1, "pages": 1, "per_page": 100, "total": 2}, recs])

    for c in ("USA", "DEU"):
        _write(os.path.join(tmp, "gdp", f"{c}.json"), doc(c))
    out = payloads.read_gdp_json(spark, os.path.join(tmp, "gdp")).orderBy("countryiso3code", "date").collect()
    assert len(out) == 4
    assert out[2].countryiso3code == "USA" and out[2].value == 1.5e12 and out[3].value is None
    assert set(out[0].asDict()) == {"countryiso3code", "date", "value"}


def test_locations_box_and_flatten(spark, tmp):
    def loc(i, lat, lon, **kw):
        d = {"id": i, "name": f"L{i}", "timezone": "America/New_York", "isMobile": False, "coordinates": {"latitude": lat, "longitude": lon}, "entity": {"type": "government"}, "sensors": [{"id": i * 10, "parameter": {"id": 2, "name": "pm25", "units": "ug/m3"}}]}
        d.update(kw)
        return d

    page = {
        "results": [
            loc(1, 40.4, -74.3),  # on the box edge: kept
            loc(2, 41.5, -74.0),  # outside
            loc(3, None, -74.0),  # missing latitude
            loc(4, 0.0, -74.0),  # zero latitude counts as missing
            loc(5, 40.7, -73.9, name=None, entity=None, timezone=None, sensors=[]),
        ]
    }
    _write(os.path.join(tmp, "loc", "p1.json"), json.dumps(page))
    locs = payloads.read_locations(spark, os.path.join(tmp, "loc"))
    box = payloads.in_box(locs)
    flat = {r.location_id: r for r in payloads.flatten_locations(box).collect()}
    assert set(flat) == {1, 5}
    assert flat[5].location_name == "Unknown" and flat[5].entity_type == "Unknown" and flat[5].timezone == "UTC"
    days = [
        {"sensor_id": 10, "results": [{"value": -1.0, "period": {"datetimeFrom": {"utc": "2020-01-01T05:00:00Z"}}}, {"value": None, "period": {"datetimeFrom": {"utc": "2020-01-02T05:00:00Z"}}}, {"value": 0.0}]},
        {"sensor_id": 999, "results": [{"value": 3.0, "period": {"datetimeFrom": {"utc": "2020-01-01T05:00:00Z"}}}]},
        {"sensor_id": 50, "results": []},
    ]
    _write(os.path.join(tmp, "days", "d.json"), "\n".join(json.dumps(d) for d in days))
    m = payloads.flatten_measurements(box, payloads.read_sensor_days(spark, os.path.join(tmp, "days"))).orderBy(F.col("date").asc_nulls_last()).collect()
    assert [(r.date, r.value, r.sensor_id, r.parameter_name) for r in m] == [("2020-01-01", -1.0, 10, "pm25"), ("2020-01-02", None, 10, "pm25"), (None, 0.0, 10, "pm25")]


def test_sensor_days_window(spark, tmp):
    stamps = ["2020-01-01T00:00:00Z", "2020-01-02T00:00:00Z", "2020-01-03T00:00:00Z", None]
    results = [{"value": float(i), "period": {"datetimeFrom": {"utc": s}}} for i, s in enumerate(stamps)]
    _write(os.path.join(tmp, "days", "d.json"), json.dumps({"sensor_id": 1, "results": results}))

    def values(*window):
        return sorted(r.value for r in payloads.read_sensor_days(spark, os.path.join(tmp, "days"), *window).collect())

    assert values() == [0.0, 1.0, 2.0, 3.0]
    assert values("2020-01-02", "2020-01-03") == [1.0, 2.0]
    assert values("2020-01-03") == [2.0]
    assert values(None, "2020-01-01") == [0.0]


def test_no_file_of_a_landing_is_good(spark, tmp):
    land = os.path.join(tmp, "land")
    pq_table = _trip_table(2, drop="fare_amount")
    os.makedirs(land)
    pq.write_table(pq_table, os.path.join(land, "a.parquet"))
    _write(os.path.join(land, "b.parquet"), "no parquet")
    res = files.load_parquet_set(spark, land, YELLOW)
    got = {os.path.basename(r.path): (r.status, r.reason) for r in res.manifest.collect()}
    assert got["a.parquet"][0] == got["b.parquet"][0] == "rejected"
    assert "fare_amount" in got["a.parquet"][1] and got["b.parquet"][1]
    assert res.data.count() == 0


def _trip_table(n, passenger_type=pa.float64(), ts_as_text=False, airport="Airport_fee", drop=None):
    base = dt.datetime(2020, 3, 1, 8, 0)
    pu = [base + dt.timedelta(hours=i) for i in range(n)]
    do = [p + dt.timedelta(minutes=12) for p in pu]
    cols = {
        "VendorID": pa.array([1] * n, pa.int64()),
        "tpep_pickup_datetime": pa.array([p.isoformat(sep=" ") for p in pu]) if ts_as_text else pa.array(pu, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([p.isoformat(sep=" ") for p in do]) if ts_as_text else pa.array(do, pa.timestamp("us")),
        "passenger_count": pa.array([1] * n).cast(passenger_type),
        "trip_distance": pa.array([2.5] * n),
        "RatecodeID": pa.array([1.0] * n),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([1] * n, pa.int64()),
        "DOLocationID": pa.array([2] * n, pa.int64()),
        "payment_type": pa.array([1] * n, pa.int64()),
        "fare_amount": pa.array([10.0] * n),
        "extra": pa.array([0.5] * n),
        "mta_tax": pa.array([0.5] * n),
        "tip_amount": pa.array([1.0] * n),
        "tolls_amount": pa.array([0.0] * n),
        "improvement_surcharge": pa.array([0.3] * n),
        "total_amount": pa.array([12.3] * n),
    }
    if airport:
        cols[airport] = pa.array([1.25] * n)
    if drop:
        cols.pop(drop)
    return pa.table(cols)


def test_parquet_set_with_drift_corrupt_and_missing_columns(spark, tmp):
    land = os.path.join(tmp, "yellow")
    os.makedirs(land)
    pq.write_table(_trip_table(3), os.path.join(land, "yellow_tripdata_2020-01.parquet"))
    pq.write_table(_trip_table(2, airport=None), os.path.join(land, "yellow_tripdata_2020-02.parquet"))
    pq.write_table(_trip_table(4, passenger_type=pa.int64(), ts_as_text=True), os.path.join(land, "yellow_tripdata_2020-03.parquet"))
    pq.write_table(_trip_table(1, airport="airport_fee"), os.path.join(land, "yellow_tripdata_2020-04.parquet"))
    with open(os.path.join(land, "yellow_tripdata_2020-05.parquet"), "wb") as f:
        f.write(b"not a parquet file at all")
    pq.write_table(_trip_table(5, drop="fare_amount"), os.path.join(land, "yellow_tripdata_2020-06.parquet"))
    res = files.load_parquet_set(spark, land, YELLOW)
    man = {os.path.basename(r.path): r.status for r in res.manifest.collect()}
    assert man["yellow_tripdata_2020-05.parquet"] == "rejected"
    assert man["yellow_tripdata_2020-06.parquet"] == "rejected"
    assert sum(1 for v in man.values() if v == "accepted") == 4
    data = res.data
    assert data.count() == 3 + 2 + 4 + 1
    fees = sorted((r.Airport_fee for r in data.collect()), key=lambda v: (v is None, v))
    assert fees.count(None) == 2  # only the file without the column
    assert files.list_files(spark, land).count() == 6


def test_month_manifest_118_and_trim(spark):
    m = files.month_manifest(spark, "2015-01", "2024-10", ["yellow_tripdata_"])
    assert m.count() == 118
    present = spark.createDataFrame([("green_tripdata_2015-02.parquet\n",)], "file_name string")
    g = files.month_manifest(spark, "2015-01", "2015-03", ["green_tripdata_\n"], present).orderBy("month").collect()
    assert [(r.file_name, r.present) for r in g] == [("green_tripdata_2015-01.parquet", False), ("green_tripdata_2015-02.parquet", True), ("green_tripdata_2015-03.parquet", False)]


def test_sinks_schema_rules(spark, tmp):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, 2.0)], "id int, v double")
    p = os.path.join(tmp, "t")
    writers.overwrite(a, p, allow_schema_change=False)
    writers.append(a, p)
    assert spark.read.parquet(p).count() == 2
    with pytest.raises(SchemaMismatchError):
        writers.append(b, p)
    with pytest.raises(SchemaMismatchError):
        writers.overwrite(b, p, allow_schema_change=False)
    writers.overwrite(b, p, allow_schema_change=True)
    assert spark.read.parquet(p).schema["v"].dataType.simpleString() == "double"
    assert writers.write_if_any(a.filter("false"), os.path.join(tmp, "never")) is False
    assert not os.path.exists(os.path.join(tmp, "never"))
    writers.write_mapped(a, os.path.join(tmp, "m"), {"id": "key"})
    assert spark.read.parquet(os.path.join(tmp, "m")).columns == ["key"]
    back = writers.write_and_reload(a, os.path.join(tmp, "r"))
    assert back.collect()[0].v == "x"


def test_streaming_loader_processes_each_file_once(spark, tmp):
    land = os.path.join(tmp, "land")
    out = os.path.join(tmp, "silver")
    ck = os.path.join(tmp, "ck")
    os.makedirs(land)
    pq.write_table(_trip_table(3), os.path.join(land, "yellow_tripdata_2020-01.parquet"))
    schema = spark.read.parquet(land).schema
    load_new_files(spark, land, YELLOW, schema, out, ck, TripRules())
    assert spark.read.parquet(out).count() == 3
    t = _trip_table(2).to_pandas()
    t["tpep_pickup_datetime"] = t["tpep_pickup_datetime"] + pd.Timedelta(days=31)
    t["tpep_dropoff_datetime"] = t["tpep_dropoff_datetime"] + pd.Timedelta(days=31)
    pq.write_table(pa.Table.from_pandas(t, preserve_index=False).cast(_trip_table(2).schema), os.path.join(land, "yellow_tripdata_2020-02.parquet"))
    load_new_files(spark, land, YELLOW, schema, out, ck, TripRules())
    got = spark.read.parquet(out)
    assert got.count() == 5
    assert {r.pickup_month for r in got.select("pickup_month").collect()} == {3, 4}


def test_files_with_damaged_pages_are_rejected_whole(spark, tmp):
    land = os.path.join(tmp, "with space")
    os.makedirs(land)
    pq.write_table(_trip_table(5000), os.path.join(land, "good 1.parquet"))
    pq.write_table(_trip_table(4), os.path.join(land, "good2.parquet"))
    pq.write_table(_trip_table(0), os.path.join(land, "no rows.parquet"))
    for name, n in (("first page.parquet", 50), ("later page.parquet", 60_000), ("changed values.parquet", 60_000)):
        p = os.path.join(land, name)
        pq.write_table(_trip_table(n), p, row_group_size=10_000, use_dictionary=False, compression="none", write_page_checksum=True)
        meta = pq.read_metadata(p)
        at = meta.row_group(meta.num_row_groups // 2).column(4).data_page_offset
        with open(p, "r+b") as f:  # a page's header, or values behind it that still decode
            f.seek(at + 400 if name.startswith("changed") else at)
            f.write(b"\xff" * 100)
    res = files.load_parquet_set(spark, land, YELLOW)
    got = {os.path.basename(r.path): (r.status, r.reason) for r in res.manifest.collect()}
    assert {k.replace("%20", " "): v[0] for k, v in got.items()} == {
        "good 1.parquet": "accepted",
        "good2.parquet": "accepted",
        "no rows.parquet": "accepted",
        "first page.parquet": "rejected",
        "later page.parquet": "rejected",
        "changed values.parquet": "rejected",
    }
    assert all("damaged" in v[1] for v in got.values() if v[0] == "rejected")
    assert res.data.count() == 5004 and files.FILE not in res.data.columns


def test_a_landing_that_only_spark_can_open(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(os.path.join(land, "y"))
    pq.write_table(_trip_table(3), os.path.join(land, "y", "a.parquet"))
    pq.write_table(_trip_table(4, passenger_type=pa.int64(), ts_as_text=True), os.path.join(land, "y", "b.parquet"))
    pq.write_table(_trip_table(5, drop="fare_amount"), os.path.join(land, "y", "c.parquet"))
    _write(os.path.join(land, "y", "d.parquet"), "no parquet")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.landing.link./in", f"file://{land}")
    res = files.load_parquet_set(spark, "viewfs://landing/in/y", YELLOW)
    got = {r.path.rsplit("/", 1)[1]: r.status for r in res.manifest.collect()}
    assert got == {"a.parquet": "accepted", "b.parquet": "accepted", "c.parquet": "rejected", "d.parquet": "rejected"}
    assert res.data.count() == 7


def test_paths_come_in_groups(spark, tmp, monkeypatch):
    land = os.path.join(tmp, "many")
    os.makedirs(land)
    for i in range(9):
        pq.write_table(_trip_table(2, passenger_type=pa.int64() if i % 2 else pa.float64()), os.path.join(land, f"{i}.parquet"))
    monkeypatch.setattr(files, "PATHS", 2)
    probed = files.probe_schemas(files.list_files(spark, land))
    groups = list(files._same_schema_groups(probed))
    assert sorted(p.rsplit("/", 1)[1] for _, g in groups for p in g) == [f"{i}.parquet" for i in range(9)] and len(groups) > 2
    assert files.load_parquet_set(spark, land, YELLOW).data.count() == 18
