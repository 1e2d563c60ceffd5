import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.functions import geo as G
from roadloom.operators.projection import fit_projection, projection_error, resolve_projection, restore_latlon
from roadloom.sources.config import read_record, speed_kmh, speeds


def test_mercator_there_and_back(spark):
    for t in (G.Tmerc.utm(32), G.Tmerc.utm(51, True), G.Tmerc(48.5, 9.25, 1.0, 10.0, -20.0)):
        lat = np.array([48.0, -33.5, 0.1, 60.2])
        lon = t.lon_0 + np.array([2.9, -2.5, 0.0, 1.0])
        back = t.inverse(*t.forward(lat, lon, G.NUMBERS), G.NUMBERS)
        assert np.allclose(back[0], lat, atol=1e-9) and np.allclose(back[1], lon, atol=1e-9)
        row = spark.range(1).select(*t.forward(F.lit(48.0), F.lit(t.lon_0 + 2.9))).first()
        assert tuple(row) == pytest.approx([float(v[0]) for v in t.forward(lat, lon, G.NUMBERS)], abs=1e-6)


def test_known_places():
    # on the central meridian the northing is the scaled meridian arc, 4984944.378 m to 45 degrees on this ellipsoid
    e, n = G.Tmerc.utm(31).forward(45.0, 3.0, G.NUMBERS)
    assert (float(e), float(n)) == pytest.approx((500000.0, 0.9996 * 4984944.378), abs=2e-3)
    assert [float(v) for v in G.web_mercator(0.0, 180.0, G.NUMBERS)] == pytest.approx([20037508.342789244, 0.0], abs=1e-6)


def test_grid_squares():
    assert G.mgrs_corner("51RUH") == (51, False, 300000.0, 2700000.0)
    assert G.mgrs_corner(" 32UPU ") == (32, False, 600000.0, 5300000.0)
    for bad in ("61RUH", "51RIH", "51IUH", "", "51RAH"):
        with pytest.raises(ValueError):
            G.mgrs_corner(bad)
    p = G.from_projector_info({"projector_type": "MGRS", "mgrs_grid": "51RUH"})
    assert "+x_0=200000 +y_0=-2700000 " in p.proj_string and p.origin_lon == 123.0
    assert G.from_projector_info({"projector_type": "local"}) is None
    local = G.from_projector_info({"projector_type": "LocalCartesianUTM", "map_origin": {"latitude": 35.6, "longitude": 139.7}})
    assert [float(v) for v in G.parse_tmerc(local.proj_string).forward(35.6, 139.7, G.NUMBERS)] == pytest.approx([0, 0], abs=1e-3)
    for bad in ({"projector_type": "X"}, {"projector_type": "MGRS"}, {"projector_type": "TransverseMercator"}):
        with pytest.raises(ValueError):
            G.from_projector_info(bad)


def test_origins():
    o = G.origin_of("+proj=utm +zone=32 +lon_0=-122 +lat_0=3 +k=1")
    assert (o.latitude, o.longitude, o.scale_factor, len(o.warnings)) == (3.0, -122.0, 1.0, 3)
    o = G.origin_of("+proj=utm +zone=32")
    assert (o.latitude, o.longitude, o.scale_factor, o.warnings) == (0.0, 9.0, 0.9996, ())
    o = G.origin_of("+proj=tmerc +lat_0=1")
    assert (o.latitude, o.scale_factor, o.bare) == (1.0, 1.0, False)
    o = G.origin_of(" +lat_0=4.9e1 +lon_0=8 ")
    assert (o.latitude, o.scale_factor, o.bare) == (49.0, 0.9996, True) and o.normalized.startswith("+proj=tmerc +lat_0=49.0 +lon_0=8.0 +k=0.9996 ")
    assert G.origin_of(None).source == "default-missing" and G.origin_of("+proj=merc").source == "default-invalid"
    assert G.origin_of("+proj=lcc +lat_0=2").latitude == 2.0


def test_reference_texts(spark):
    good = ["+proj=utm +zone=32 +datum=WGS84", "+proj=tmerc +lat_0=0 +no_defs", "EPSG:4326", 'PROJCS["x"]']
    bad = ["+lat_0=1 +lon_0=2", "+proj=nonsense", "hello", "+proj=utm", "+proj=utm +zone=61", ""]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    assert [r[0] for r in df.select(G.crs_is_valid(F.col("t"))).collect()] == [True] * len(good) + [False] * len(bad)
    row = spark.range(1).select(G.proj_param(F.lit("+x_0=5.5 +y=x"), "x_0"), G.proj_param(F.lit("+x_0=5.5 +y=x"), "y"), G.proj_param(F.lit(""), "k")).first()
    assert tuple(row) == (5.5, None, None)


@pytest.mark.parametrize("kind", ["utm", "mercator", "noise"])
def test_fit(spark, kind):
    rng = np.random.default_rng(0)
    lat, lon = 49 + rng.random(50) / 100, 8.4 + rng.random(50) / 100
    x, y = G.Tmerc.utm(32).forward(lat, lon, G.NUMBERS) if kind != "mercator" else G.web_mercator(lat, lon, G.NUMBERS)
    x, y = x - 1234.5, y + 77.25
    if kind == "noise":
        x = x + rng.normal(0, 5, 50)
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in (lat, lon, x, y)))), "lat double, lon double, x double, y double")
    got = fit_projection(df)
    if kind == "noise":
        assert got is None
        return
    assert got.source == ("fit-utm32N" if kind == "utm" else "fit-webmercator") and got.fit_rmse < 1e-3
    assert projection_error(got.native, df)[0] < 0.01
    assert fit_projection(df.limit(1)) is None


def test_resolve_and_restore(spark):
    lat, lon = [49.0, 49.002, 49.004], [8.0, 8.002, 8.004]
    t = G.Tmerc.utm(32)
    nodes = [("m", k, a, b, {"local_x": repr(float(x)), "local_y": repr(float(y))}) for k, (a, b) in enumerate(zip(lat, lon)) for x, y in [t.forward(a, b, G.NUMBERS)]]
    df = spark.createDataFrame(nodes, "map_id string, ord long, lat double, lon double, tags map<string,string>")
    got = resolve_projection(df)
    assert got.source == "fit-utm32N" and (got.origin_lat, got.origin_lon) == (49.002, 8.002) and got.nodes_checked == 3 and got.max_node_error < 1e-3
    assert resolve_projection(df, frame="mgrs", given=t.text).source == "cli"
    with pytest.raises(ValueError):
        resolve_projection(df, frame="other")
    blank = df.withColumn("lat", F.when(F.col("ord") > 0, F.col("lat")))
    back = [tuple(r) for r in restore_latlon(blank, t.text).orderBy("ord").select("lat", "lon").collect()]
    assert [v for r in back for v in r] == pytest.approx([v for r in zip(lat, lon) for v in r], abs=1e-9)


def test_config(spark, tmp_path):
    assert read_record(str(tmp_path / "none.yaml")) == {}
    (tmp_path / "a.yaml").write_text('{"autoware": {"default_speed_kmh": {"urban": 40, "odd": 1}}}')
    assert speeds(read_record(str(tmp_path / "a.yaml"))) == {"urban": 40.0, "nonurban": 60.0, "private": 30.0}
    (tmp_path / "b.yaml").write_text("[1]")
    with pytest.raises(ValueError):
        read_record(str(tmp_path / "b.yaml"))
    df = spark.createDataFrame([("50", "urban"), ("30mph", None), ("50 km/h", None), ("", "private"), (None, "nonurban"), ("fast", None)], "s string, l string")
    got = [r[0] for r in df.select(speed_kmh(F.col("s"), F.col("l"))).collect()]
    assert got == [50.0, pytest.approx(48.28032), 50.0, 30.0, 60.0, None]
