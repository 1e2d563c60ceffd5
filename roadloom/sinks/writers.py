"""Writing maps and reports: XML documents, id tables, sidecar files, and check reports."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from pathlib import Path
from xml.sax.saxutils import quoteattr

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom import model as M
from roadloom.functions import geo as G
from roadloom.operators.maptables import MAP, MapTables
from roadloom.storage import Scratch


def _attr(name: str, value: Column) -> Column:
    """name="value" with the value escaped, or nothing for null."""
    safe = value.cast("string")
    for raw, text in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;")):
        safe = F.replace(safe, F.lit(raw), F.lit(text))
    return F.coalesce(F.concat(F.lit(f' {name}="'), safe, F.lit('"')), F.lit(""))


def _tags(tags: Column) -> Column:
    line = lambda e: F.concat(F.lit("<tag"), _attr("k", e["key"]), _attr("v", e["value"]), F.lit("/>"))
    return F.coalesce(F.concat_ws("", F.transform(F.array_sort(F.map_entries(tags)), line)), F.lit(""))


def tag_map(**cols: Column) -> Column:
    """A map of the tags that are present; null ones are left out."""
    return F.map_filter(F.map_from_entries(F.array(*[F.struct(F.lit(k), v.cast("string")) for k, v in cols.items()])), lambda _, v: v.isNotNull())


@F.arrow_udf(T.StringType())
def fixed_text(value: pa.Array) -> pa.Array:
    """A number with four decimals, rounded by its exact binary value; the JVM rounds the shortest decimal text instead,
    which differs where that ends in a 5."""
    return pa.array([None if v is None else f"{v:.4f}" for v in value.to_pylist()], pa.string())


def osm_lines(t: MapTables) -> DataFrame:
    """(map_id, part, ord, xml): one line of XML per element: nodes, ways and relations, each in document order."""
    fixed = lambda c: fixed_text(F.col(c))
    node = t.node.select(MAP, F.lit(0).alias("part"), F.col("node_id").cast("string").alias("id"), F.concat(F.lit("<node"), _attr("id", F.col("node_id")), F.lit(' visible="true" version="1" lat="" lon="">'), _tags(tag_map(local_x=fixed("x"), local_y=fixed("y"), ele=F.when(F.col("ele").isNotNull(), fixed("ele")))), F.lit("</node>")).alias("xml"))
    node = node.withColumn("ord", F.coalesce(F.col("id").try_cast("bigint"), F.lit(0)))
    nd = t.way_node.groupBy(MAP, "way_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("seq", "node_id"))), lambda s: F.concat(F.lit("<nd"), _attr("ref", s["node_id"]), F.lit("/>")))).alias("nds"))
    way = t.way.join(nd, [MAP, "way_id"], "left")
    way = way.select(MAP, F.lit(1).alias("part"), F.col("way_id").cast("string").alias("id"), "ord", F.concat(F.lit("<way"), _attr("id", F.col("way_id")), F.lit(">"), F.coalesce("nds", F.lit("")), _tags(tag_map(type=F.col("type"), subtype=F.col("subtype"), lane_change=F.col("lane_change"))), F.lit("</way>")).alias("xml"))
    mem = t.member.groupBy(MAP, "rel_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("seq", "mtype", "ref", "role"))), lambda s: F.concat(F.lit("<member"), _attr("type", s["mtype"]), _attr("ref", s["ref"]), _attr("role", s["role"]), F.lit("/>")))).alias("members"))
    names = ("type", "subtype", "location", "one_way", "speed_limit", "turn_direction", "intersection_area")
    rel = t.relation.join(mem, [MAP, "rel_id"], "left")
    tags = tag_map(**{k: F.col(k) for k in names}, **{"participant:pedestrian": F.col("pedestrian")})
    rel = rel.select(MAP, F.lit(2).alias("part"), F.col("rel_id").cast("string").alias("id"), "ord", F.concat(F.lit("<relation"), _attr("id", F.col("rel_id")), F.lit(">"), F.coalesce("members", F.lit("")), _tags(tags), F.lit("</relation>")).alias("xml"))
    cols = [MAP, "part", "ord", "id", "xml"]
    return node.select(*cols).unionByName(way.select(*cols)).unionByName(rel.select(*cols))


def map_file(map_id: object, root: str = "") -> str:
    """The file of a map below the output folder: its own path below ``root`` (without scheme and leading slashes), so that
    maps of one file name in different folders stay apart; with the suffix of lanelet maps."""
    bare = lambda p: re.sub(r"^[a-z0-9+.-]+:/*", "", p).strip("/")
    name, root = bare(str(map_id)), bare(root)
    name = name.removeprefix(root + "/") if root else name
    parts = [p.replace(":", "_") for p in name.split("/") if p not in ("", ".", "..")] or ["_"]
    return "/".join(parts) + ("" if parts[-1].endswith(".osm") else ".osm")


def write_osm(t: MapTables, folder: str, root: str = "") -> DataFrame:
    """One document per map at ``map_file``; returns (map_id, file). Elements are formatted in the JVM; the lines of a map
    meet sorted in one task, which streams them to a draft on the file system of ``folder`` (any that Arrow knows) and
    gives it its name once it is whole, so a repeated task never leaves a part of a document. A map that is no path goes
    by its own text."""

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        disk, base = pa_fs.FileSystem.from_uri(folder if re.match(r"^[a-z0-9+.-]+:", folder) else str(Path(folder).absolute()))
        out, current, draft, done = None, None, "", []

        def close() -> None:
            out.write(b"</osm>\n")
            out.close()
            disk.move(draft, f"{base}/{done[-1][1]}")

        for df in batches:
            for name, xml in zip(df[MAP], df["xml"]):
                if out is None or name != current:
                    if out:
                        close()
                    file = map_file(name, root)
                    disk.create_dir(f"{base}/{file}".rpartition("/")[0], recursive=True)
                    draft = f"{base}/{file}.{uuid.uuid4().hex[:8]}.draft"
                    current, out = name, disk.open_output_stream(draft)
                    out.write(b"<?xml version='1.0' encoding='UTF-8'?>\n<osm version=\"0.6\" generator=\"roadloom\">\n")
                    done.append((str(name), file))
                out.write((xml + "\n").encode("utf-8", "replace"))
        if out:
            close()
        yield pd.DataFrame(done, columns=["map_id", "file"])

    lines = osm_lines(t).repartition(MAP).sortWithinPartitions(MAP, "part", "ord", "id").select(MAP, "xml")
    return Scratch(t.node.sparkSession, "written").save(lines.mapInPandas(save, "map_id string, file string"), "files")


def write_csv(df: DataFrame, path: str, order: list) -> None:
    """CSV with a header, sorted: files in ranges of the order, named in that order."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def forward_mapping(ids: DataFrame) -> DataFrame:
    """The id table from plan view to lanelets, in the order of its keys."""
    return ids.select(F.col("road").alias("opendrive_road_id"), F.col("section").alias("opendrive_section_id"), F.col("lane").alias("opendrive_lane_id"), F.col("relation").alias("lanelet2_relation_id")).orderBy("opendrive_road_id", "opendrive_section_id", "opendrive_lane_id")


def number_then_text(col: str) -> list[Column]:
    """Sorts ids that are whole numbers by value, before all others by text."""
    return [F.col(col).try_cast("bigint").asc_nulls_last(), F.col(col)]


def timing_log(files: DataFrame, times: DataFrame) -> DataFrame:
    """Seconds per file, with a row for every file: those that gave no time failed."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("conversion_failed")).alias(c)
    cols = ("conversion_time_secs", "mapping_time_secs", "downsampling_time_secs", "total_time_secs")
    return files.join(times, ["set_name", "input_file"], "left").select("set_name", "input_file", *[fill(c) for c in cols])


def report_lines(results: DataFrame) -> DataFrame:
    """A line of text per check; the fraction only where something was counted."""
    part = F.when(F.col("total") > 0, F.format_string(" (%d/%d)", "offenders", "total")).otherwise("")
    return results.select(MAP, "req_id", F.concat(F.lit("  "), F.rpad("req_id", 9, " "), F.lit(" "), F.rpad("status", 4, " "), F.lit(" "), "name", F.lit(" — "), "detail", part).alias("line"))


def report_json(results: DataFrame) -> DataFrame:
    """(map_id, json): all results of a map as one document."""
    cols = ("req_id", "name", "status", "detail", "offenders", "total")
    return results.groupBy(MAP).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*cols)))).alias("json"))


def metrics_json(metrics: DataFrame, worst: DataFrame) -> DataFrame:
    """(map_id, json): the fidelity metrics of each map as one document, with its worst matches (map_id, rel_id, iou)."""
    last = worst.groupBy(MAP).agg(F.array_sort(F.collect_list(F.struct("iou", "rel_id"))).alias("worst"))
    cols = [c for c in metrics.columns if c != MAP]
    return metrics.join(last, MAP, "left").select(MAP, F.to_json(F.struct(*cols, F.coalesce("worst", F.array()).alias("worst")), {"ignoreNullFields": "false"}).alias("json"))


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """The fidelity metrics as short texts: shares to three decimals, square metres to one, metres to two."""
    trio = lambda form, *cols: F.format_string("/".join([form] * 3), *cols)
    texts = {
        "lanelets": F.format_string("%d->%d", "lanelets_original", "lanelets_roundtrip"), "union_iou": F.round("union_iou", 3), "uncovered_m2": F.round("uncovered_area", 1), "extra_m2": F.round("extra_area", 1),
        "match_iou_p50/p90/min": trio("%.3f", "match_iou_p50", "match_iou_p90", "match_iou_min"), "boundary_dev_p50/p90/max_m": trio("%.2f", "boundary_dev_p50", "boundary_dev_p90", "boundary_dev_max"),
    }
    have = {k: v for k, v in texts.items() if k not in ("union_iou", "uncovered_m2", "extra_m2") or {"union_iou", "uncovered_area", "extra_area"} <= set(metrics.columns)}
    return metrics.select(MAP, *[v.alias(k) for k, v in have.items()])


def simulator_report(checks: DataFrame, facts: DataFrame) -> DataFrame:
    """(map_id, json, summary): a simulator import's facts (map_id and any columns) and checks (map_id, check, status,
    detail) as one document per map, and a line that counts them."""
    many = lambda s: F.count_if(F.col("status") == s)
    line = F.format_string("import check: %d PASS, %d WARN, %d FAIL of %d", many(M.PASS), many(M.WARN), many(M.FAIL), F.count("*"))
    per = checks.groupBy(MAP).agg(F.array_sort(F.collect_list(F.struct("check", "status", "detail"))).alias("results"), line.alias("summary"))
    cols = [c for c in facts.columns if c != MAP]
    return facts.join(per, MAP, "left").select(MAP, F.to_json(F.struct(*cols, "results")).alias("json"), F.coalesce("summary", F.lit("import check: 0 PASS, 0 WARN, 0 FAIL of 0")).alias("summary"))


def exit_code(results: DataFrame) -> int:
    """1 if any check fails."""
    return int(bool(results.agg(F.bool_or(F.col("status") == M.FAIL)).first()[0]))


def output_stem(path: Column) -> Column:
    """The name for what is made from a file: its own, but its folder's for the common file name of lanelet maps."""
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.when(stem == "lanelet2_map", F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)).otherwise(stem)


def origin_record(o: G.Origin) -> dict:
    return {"projector_type": o.projector_type, "vertical_datum": o.vertical_datum, "map_origin": {"latitude": o.latitude, "longitude": o.longitude}, "scale_factor": o.scale_factor}


def write_yaml(path: str, record: dict) -> None:
    """A sidecar file; keys without value are left out. Written as JSON, which is YAML too, where there is no YAML
    library."""
    record = {k: v for k, v in record.items() if v is not None}
    try:
        import yaml

        text = yaml.safe_dump(record, sort_keys=False, allow_unicode=True)
    except ImportError:
        text = json.dumps(record, indent=2, ensure_ascii=False) + "\n"
    Path(path).write_text(text, encoding="utf-8")


def with_georeference(xml: str, text: str) -> str:
    """A plan-view document with its reference text replaced, as CDATA; put into the header where it has none."""
    safe = text.replace("]]>", "]]]]><![CDATA[>")
    element = f"<geoReference><![CDATA[{safe}]]></geoReference>"
    out, n = re.subn(r"<geoReference\b[^>]*?(/>|>.*?</geoReference>)", lambda _: element, xml, count=1, flags=re.S)
    if n:
        return out
    out, n = re.subn(r"(<header\b[^>]*?)/>", lambda m: f"{m[1]}>{element}</header>", xml, count=1)
    return out if n else re.sub(r"(<header\b[^>]*>)", lambda m: m[1] + element, xml, count=1)


def plan_road_xml(name: str, road_id: str, length: float, prims: list) -> str:
    """A road element from primitives."""
    parts = []
    for p in prims:
        kind = {"line": "<line/>", "arc": f"<arc curvature={quoteattr(repr(p.curvature))}/>", "spiral": f"<spiral curvStart={quoteattr(repr(p.curvature))} curvEnd={quoteattr(repr(p.curv_end))}/>"}.get(p.kind)
        if kind is None:
            coef = "".join(f' {n}{c}="{v!r}"' for c, poly in (("U", p.u), ("V", p.v)) for n, v in zip("abcd", poly))
            kind = f'<paramPoly3{coef} pRange="{"normalized" if p.normalized else "arcLength"}"/>'
        parts.append(f'<geometry s="{p.s!r}" x="{p.x!r}" y="{p.y!r}" hdg="{p.hdg!r}" length="{p.length!r}">{kind}</geometry>')
    return f"<road name={quoteattr(name)} length=\"{length!r}\" id={quoteattr(road_id)} junction=\"-1\"><planView>{''.join(parts)}</planView></road>"
