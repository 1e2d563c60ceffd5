"""Fitting, checking and choosing a map's projection from its nodes: aggregates in Spark, one row to the driver for one
map, one row per map for many."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import geo as G
from roadloom.operators.skew import relay_join
from roadloom.storage import Scratch

MAP = "map_id"


def candidates(lat: float, lon: float) -> list[tuple[str, G.Tmerc | None]]:
    """UTM of the zone and its neighbours, and Web Mercator (none)."""
    import math

    zone, south = int(math.floor((lon + 180) / 6)) + 1, lat < 0
    utm = [(f"fit-utm{z}{'S' if south else 'N'}", G.Tmerc.utm(z, south)) for z in (zone, zone - 1, zone + 1) if 1 <= z <= 60]
    return [*utm, ("fit-webmercator", None)]


def fit_projection(samples: DataFrame) -> G.Projection | None:
    """The candidate whose coordinates, moved by the mean residual, come closest to local_x and local_y, if its root
    mean square error is at most 5 cm. All candidates are fitted in one aggregate over ``samples`` (lat, lon, x, y):
    the error after removing the mean is the residual's variance, so one pass is enough. Fewer than two nodes fit
    nothing."""
    middle = samples.agg(F.avg("lat"), F.avg("lon"), F.count("*")).first()
    if middle[2] < 2:
        return None
    tried = candidates(middle[0], middle[1])
    aggs = []
    for i, (_, t) in enumerate(tried):
        px, py = t.forward(F.col("lat"), F.col("lon")) if t else G.web_mercator(F.col("lat"), F.col("lon"))
        rx, ry = F.col("x") - px, F.col("y") - py
        aggs += [F.avg(rx).alias(f"dx{i}"), F.avg(ry).alias(f"dy{i}"), F.sqrt(F.var_pop(rx) + F.var_pop(ry)).alias(f"e{i}")]
    row = samples.agg(*aggs).first()
    best = min(range(len(tried)), key=lambda i: row[f"e{i}"])
    if row[f"e{best}"] > M.FIT_ACCEPT:
        return None
    name, t = tried[best]
    dx, dy = row[f"dx{best}"], row[f"dy{best}"]
    if t is None:
        text = f"{G.WEB_MERCATOR} +x_0={dx:.6f} +y_0={dy:.6f}"
        return G.Projection(text, text, name, 0.0, 0.0, 1.0, fit_rmse=row[f"e{best}"])
    t = replace(t, x_0=round(t.x_0 + dx, 6), y_0=round(t.y_0 + dy, 6))
    return G.Projection(t.text, t.text, name, t.lat_0, t.lon_0, t.k, fit_rmse=row[f"e{best}"])


def _spread(samples: DataFrame, per_map: DataFrame) -> DataFrame:
    return relay_join(samples, per_map, [MAP], F.xxhash64("lat", "lon", "x", "y"))


def fit_projections(samples: DataFrame) -> DataFrame:
    """(map_id, candidate, source, rmse, max_error, nodes): ``fit_projection`` for every map of ``samples`` (map_id, lat,
    lon, x, y) at once, each with the zone and hemisphere of its own mean place, which are columns here.

    The candidate is the best one of the map, with its root mean square error and its greatest node error, both after
    the mean residual is taken off; source names it only where it is accepted. A map of fewer than two nodes has neither.
    """
    n = Scratch(samples.sparkSession, "fit").save(samples.dropna(), "samples")
    mean = n.groupBy(MAP).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("nodes"))
    zone = mean.where("nodes > 1").select(MAP, (F.col("lat") < 0).alias("south"), G.utm_zone(F.col("lon")).alias("zone"))
    tried = [0, -1, 1, None]  # zones beside the map's own; none is Web Mercator

    def utm(zone: Column) -> tuple:
        t = G.Tmerc(0.0, G.central_meridian(zone), M.UTM_SCALE, 500000.0, F.when(F.col("south"), 10000000.0).otherwise(0.0))
        return t.forward(F.col("lat"), F.col("lon"))

    mercator = G.web_mercator(F.col("lat"), F.col("lon"))
    aggs = []
    for i, step in enumerate(tried):
        px, py = mercator if step is None else utm(F.col("zone") + step)
        rx, ry = F.col("x") - px, F.col("y") - py
        aggs += [F.avg(rx).alias(f"dx{i}"), F.avg(ry).alias(f"dy{i}"), F.sqrt(F.var_pop(rx) + F.var_pop(ry)).alias(f"e{i}")]
    errors = _spread(n, zone).where("zone is not null").groupBy(MAP, "zone", "south").agg(*aggs)
    name = lambda step: F.lit("fit-webmercator") if step is None else F.concat(F.lit("fit-utm"), F.col("zone") + step, F.when(F.col("south"), "S").otherwise("N"))
    there = lambda step: F.lit(True) if step is None else (F.col("zone") + step).between(1, 60)
    of = lambda i, step: F.when(there(step), F.struct(F.col(f"e{i}").alias("rmse"), F.lit(i).alias("nth"), (F.lit(None).cast("int") if step is None else F.col("zone") + step).alias("at"), name(step).alias("candidate"), F.col(f"dx{i}").alias("dx"), F.col(f"dy{i}").alias("dy")))
    best = errors.select(MAP, "south", F.least(*[of(i, step) for i, step in enumerate(tried)]).alias("b")).select(MAP, "south", "b.*")
    best = Scratch(samples.sparkSession, "fit").save(best, "best")
    off = lambda px, py: F.hypot(px + F.col("dx") - F.col("x"), py + F.col("dy") - F.col("y"))
    far = F.when(F.col("at").isNull(), off(*mercator)).otherwise(off(*utm(F.col("at"))))
    worst = _spread(n, best).where("nth is not null").groupBy(MAP).agg(F.max(far).alias("max_error"))
    fits = best.join(worst, MAP).select(MAP, "candidate", F.when(F.col("rmse") <= M.FIT_ACCEPT, F.col("candidate")).alias("source"), "rmse", "max_error")
    every = samples.select(MAP).distinct().join(mean.select(MAP, "nodes"), MAP, "left").fillna(0, ["nodes"])
    return every.join(fits, MAP, "left").select(MAP, "candidate", "source", "rmse", "max_error", "nodes")


def projected(text: str, lat, lon, m=G.COLUMNS):
    """Coordinates of a supported projection text."""
    t = G.parse_tmerc(text)
    if t is not None:
        return t.forward(lat, lon, m)
    p = G.proj_params(text)
    if p.get("proj") != "merc":
        raise ValueError(f"projection not supported: {text!r}")
    x, y = G.web_mercator(lat, lon, m)
    shift = lambda k: float(p.get(k) or 0.0)
    return x + shift("x_0"), y + shift("y_0")


def projection_error(text: str, samples: DataFrame) -> tuple[float | None, int]:
    """The greatest distance between projected and given coordinates, and the number of nodes; none without any."""
    x, y = projected(text, F.col("lat"), F.col("lon"))
    row = samples.agg(F.max(F.hypot(x - F.col("x"), y - F.col("y"))), F.count("*")).first()
    return row[0], row[1]


def resolve_projection(nodes: DataFrame, info: dict | None = None, given: str | None = None, frame: str = "local", most: int = 2000) -> G.Projection:
    """The projection of one map: the given text, else the projector record, else a fit to the nodes, else UTM; checked
    against the nodes, and for the local frame moved to the middle of the nodes' bounds, to six decimals.

    ``nodes`` has map_id, ord, lat, lon and tags.
    """
    from roadloom.sources.osm_xml import node_samples

    tag = lambda k: F.col("tags")[k].try_cast("double")
    samples = node_samples(nodes, most).select("lat", "lon", tag("local_x").alias("x"), tag("local_y").alias("y")).dropna()
    box = nodes.where("lat is not null and lon is not null").agg(F.avg("lat"), F.avg("lon"), F.bround((F.min("lat") + F.max("lat")) / 2, 6), F.bround((F.min("lon") + F.max("lon")) / 2, 6)).first()
    found = None
    if given:
        p = G.parse_tmerc(given)
        found = G.Projection(given, given, "cli", p.lat_0 if p else None, p.lon_0 if p else None, p.k if p else None)
    found = found or (G.from_projector_info(info) if info else None) or fit_projection(samples) or G.fallback_utm(box[0], box[1])
    error, count = projection_error(found.native, samples)
    found = replace(found, max_node_error=error, nodes_checked=count)
    if frame == "mgrs":
        return replace(found, frame=frame)
    if frame != "local":
        raise ValueError(f"unknown frame {frame!r}")
    if box[2] is None:
        raise ValueError("the local frame needs nodes with latitude and longitude")
    local = G.local_frame(box[2], box[3])
    return replace(found, frame=frame, proj_string=local.text, origin_lat=local.lat_0, origin_lon=local.lon_0, scale_factor=1.0)


def restore_latlon(nodes: DataFrame, native: str) -> DataFrame:
    """Nodes with lat and lon filled from local_x and local_y where either is missing, to 11 decimals; an error where
    those are missing too."""
    t = G.parse_tmerc(native)
    if t is None:
        raise ValueError(f"no inverse for {native!r}")
    tag = lambda k: F.coalesce(F.col("tags")[k].try_cast("double"), F.raise_error(F.lit("a node has neither lat/lon nor local_x/local_y")).cast("double"))
    blank = F.col("lat").isNull() | F.col("lon").isNull()
    lat, lon = t.inverse(tag("local_x"), tag("local_y"))
    return nodes.withColumns({"lat": F.when(blank, F.round(lat, 11)).otherwise(F.col("lat")), "lon": F.when(blank, F.round(lon, 11)).otherwise(F.col("lon"))})
