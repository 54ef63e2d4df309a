"""End to end over landed files with the original parameters."""

from __future__ import annotations

import json
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata.plans import questions, reports
from strata.plans.lakehouse import LandedLakehouse

from .test_sources_sinks import _trip_table, _write


def _land(root):
    os.makedirs(os.path.join(root, "yellow"))
    os.makedirs(os.path.join(root, "green"))
    pq.write_table(_trip_table(6), os.path.join(root, "yellow", "yellow_tripdata_2020-03.parquet"))
    g = _trip_table(4, airport=None).rename_columns([c.replace("tpep_", "lpep_") for c in _trip_table(4, airport=None).column_names])
    pq.write_table(g, os.path.join(root, "green", "green_tripdata_2020-03.parquet"))
    loc = {"results": [{"id": 1, "name": "Queens", "timezone": "America/New_York", "isMobile": False,
                        "coordinates": {"latitude": 40.7, "longitude": -73.8}, "entity": {"type": "government"},
                        "sensors": [{"id": 10, "parameter": {"id": 2, "name": "pm25", "units": "ug/m3"}},
                                    {"id": 11, "parameter": {"id": 3, "name": "o3", "units": "ppm"}}]}]}
    _write(os.path.join(root, "locations", "page1.json"), json.dumps(loc))
    days = [{"sensor_id": 10, "results": [{"value": v, "period": {"datetimeFrom": {"utc": f"2020-03-0{d}T05:00:00Z"}}} for d, v in ((1, 8.5), (2, 9.0))]},
            {"sensor_id": 11, "results": [{"value": 0.03, "period": {"datetimeFrom": {"utc": "2020-03-01T05:00:00Z"}}}]}]
    _write(os.path.join(root, "sensor_days", "d.json"), "\n".join(json.dumps(d) for d in days))
    _write(os.path.join(root, "zones.csv"), "LocationID,Borough,Zone,service_zone\n1,Queens,Astoria,Boro Zone\n2,Queens,Jamaica,Boro Zone\n")
    from strata.sources.payloads import FX_CSV

    names = [f.name for f in FX_CSV.fields]
    rows = []
    for day, rate in (("2020-03-02", "1.1"), ("2020-03-03", "1.2")):
        vals = {n: "" for n in names}
        vals.update({"CURRENCY": "USD", "CURRENCY_DENOM": "EUR", "TIME_PERIOD": day, "OBS_VALUE": rate})
        rows.append(",".join(vals[n] for n in names))
    _write(os.path.join(root, "fx.csv"), ",".join(names) + "\n" + "\n".join(rows) + "\n")
    rec = lambda y, v: {"indicator": {"id": "X", "value": "GDP"}, "country": {"id": "US", "value": "US"}, "countryiso3code": "USA", "date": str(y), "value": v, "unit": "", "obs_status": "", "decimal": 0}
    _write(os.path.join(root, "gdp", "us.json"), json.dumps([{"page": 1}, [rec(2019, 2.1e13), rec(2020, 2.0e13)]]))


def test_landed_lakehouse_end_to_end(spark, tmp):
    _land(tmp)
    lh = LandedLakehouse(spark, tmp)
    assert lh.silver_trips.count() == 10
    assert {r.status for r in lh.landing_manifest.collect()} == {"accepted"}
    assert lh.fact_taxi.agg(F.sum("trip_count")).collect()[0][0] == 10
    top = reports.top_zones(lh.taxi_cut, lh.dim_zone, lh.options).collect()
    assert [(r.pickup_zone_id, r.zone_name, r.trip_count) for r in top] == [(1, "Astoria", 10)]
    pick = {r.parameter_name: r.selected for r in reports.pollutant_candidates(lh.air_cut, lh.options.pollutant).collect()}
    assert pick == {"pm25": True, "o3": False}
    assert reports.pollutant_kpis(lh.pollutant).collect()[0].avg_value == 8.75
    rev = lh.revenue_fx.collect()
    assert len(rev) == 1 and rev[0].usd_eur_rate == 1.15
    g = reports.revenue_gdp_yearly(lh.revenue_fx, lh.dim_gdp, lh.options).collect()
    assert g[0].gdp_usd == 2.0e13
    q1 = questions.daily_corr(lh.fact_taxi, lh.fact_air, lh.air_cut, lh.options).collect()[0]
    assert q1.n_days == 1 and q1.correlation is None  # one common day: a single pair has no correlation
    assert lh.locations.collect()[0].location_name == "Queens"
