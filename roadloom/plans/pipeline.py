"""The conversions' visible passes in their order, each switchable, on tables from files or elsewhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import map_checks, passes, plan_checks
from roadloom.operators.maptables import MapTables
from roadloom.sources.osm_xml import osm_tables, read_osm
from roadloom.sources.xodr_xml import PlanTables, read_xodr
from roadloom.storage import Scratch


@dataclass
class Cleaned:
    tables: MapTables
    stats: dict[str, DataFrame] = field(default_factory=dict)


def clean_map(t: MapTables, repair: bool = True, dedup: bool = True, downsample: bool = True, split: bool = True, borders: bool = True) -> Cleaned:
    """End repair, removal of duplicates, simplification, splitting and border tagging, in this order, which matters:
    repair needs the dense raw points, duplicates must go before they are cut, borders are told on the final pieces.
    Without simplification nothing is split either. Tables are written between the passes."""
    store = Scratch(t.node.sparkSession, "clean")
    done = Cleaned(t.saved(store, "raw"))

    def step(name: str, result: tuple[MapTables, DataFrame]) -> None:
        done.tables = result[0].saved(store, name)
        done.stats[name] = store.save(result[1], f"{name}-stats")

    if repair:
        step("repair", passes.repair_ends(done.tables))
    if dedup:
        step("dedup", passes.dedup_lanelets(done.tables, done.tables.relation.select("map_id", "rel_id", "tags")))
    if downsample:
        step("downsample", passes.downsample(done.tables))
        if split:
            step("split", passes.split_lanelets(done.tables))
    if borders:
        step("borders", passes.road_borders(done.tables))
    return done


def check_files(spark: SparkSession, path: str) -> DataFrame:
    """Check results of all lane-level files below a path; a file that cannot be read has one failed row."""
    elements = Scratch(spark, "checks").save(read_osm(spark, path), "elements")
    bad = elements.where("elem = 'error'").select("map_id", F.lit("parse").alias("req_id"), F.lit("file readable").alias("name"), F.lit("FAIL").alias("status"), F.col("error").alias("detail"), F.lit(1).cast("bigint").alias("offenders"), F.lit(1).cast("bigint").alias("total"))
    return map_checks.check_map(osm_tables(elements)).unionByName(bad)


def check_plan_files(spark: SparkSession, path: str) -> DataFrame:
    """Check results of all plan-view files below a path; a file that cannot be read has one failed row."""
    rows = Scratch(spark, "checks").save(read_xodr(spark, path), "rows")
    bad = rows.where("elem = 'error'").select("map_id", F.lit("parse").alias("req_id"), F.lit("file readable").alias("name"), F.lit("FAIL").alias("status"), F.col("text").alias("detail"), F.lit(1).cast("bigint").alias("offenders"), F.lit(1).cast("bigint").alias("total"))
    return plan_checks.check_plan(PlanTables(rows)).unionByName(bad)
