"""Whole runs by contract: raw feeds to trusted tables, trusted tables to marts."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.scalars import lookup, normalize_text
from lakeloom.functions.temporal import local_time, to_instant, within
from lakeloom.operators import dedupe, reshape, validate
from lakeloom.operators.aggregate import weighted_mean
from lakeloom.plans import marts
from lakeloom.plans.contract import Contract, Feed, TableRules, first_known
from lakeloom.plans.spans import Days, Reach, days_to_read
from lakeloom.sources import readers, sinks

log = logging.getLogger(__name__)
TS, LOCAL = "ts_utc", "ts_local"


@dataclass
class Loaded:
    """What a run wrote of one table, and a report for each feed."""

    table: str
    window: Days
    n_written: int = 0
    n_quarantined: int = 0
    reports: list[validate.ValidationReport] = field(default_factory=list)

    def save(self, path: str) -> None:
        out = {"table": self.table, "window": f"{self.window.start}_{self.window.end}", "written": self.n_written, "quarantined": self.n_quarantined, "feeds": [r.as_dict() for r in self.reports]}
        with open(path, "w", encoding="utf-8") as f:
            json.dump(out, f, indent=1)


def quality_of(df: DataFrame, contract: Contract, feed: Feed) -> Column:
    """The quality that a row's own column tells, else the feed's."""
    column = first_known(contract.quality_columns, df.columns)
    told = lookup(contract.quality_texts, normalize_text(F.col(f"`{column}`"))) if column else F.lit(None)
    return F.coalesce(told.cast("string"), F.lit(feed.default_quality).cast("string"))


def traced(df: DataFrame, contract: Contract, feed: Feed, zone_id: str | None = None) -> DataFrame:
    """Rows with instant, local time, quality and its rank, zone, source, file and time of ingestion.

    The time of ingestion is the raw layer's where it left one, so that a replay decides between
    equal rows as the first run did; else it is now. Zones and files that rows have are kept.
    """
    instants = first_known(contract.instants, df.columns)
    if instants is None:
        raise validate.ValidationError(f"{feed.name} has none of the columns {', '.join(contract.instants)}")
    held = lambda c, other: F.col(c) if c in df.columns else other
    zone = held("zone_id", F.lit(None)) if zone_id is None else F.lit(zone_id)
    rows = df.withColumn(TS, to_instant(F.col(f"`{instants}`"), contract.zone))
    rows = rows.withColumns(
        {
            LOCAL: local_time(F.col(TS), contract.zone),
            "quality": quality_of(df, contract, feed),
            "zone_id": zone.cast("string"),
            "source": F.lit(feed.name),
            "source_file": held("source_file", F.lit("")).cast("string"),
            "ingested_at": F.coalesce(held("bronze_ingested_at", F.lit(None)).cast("timestamp"), F.current_timestamp()),
        }
    )
    return rows.withColumn("quality_rank", dedupe.quality_rank(F.col("quality"), contract.qualities, contract.unknown_rank))


def unparsed(contract: Contract, columns: Sequence[str]) -> Column:
    """Whether a row of traced() tells a time that doesn't parse."""
    column = first_known(contract.instants, columns)
    return (F.trim(F.col(f"`{column}`").cast("string")) != "") & F.col(TS).isNull()


def projected(df: DataFrame, spec: TableRules) -> DataFrame:
    """The table's columns in the contract's order: lineage that rows have, dimensions, measures."""
    wanted = [*spec.lineage, *[d.target for d in spec.dimensions], *[m.target for m in spec.measures]]
    extra = [spec.member, "member_level", "member_category", "member_flag", "member_parent"] if spec.levels else []
    return df.select([c for c in dict.fromkeys([*wanted, *extra]) if c in df.columns])


def checked(spark: SparkSession, contract: Contract, spec: TableRules, feed: Feed, root: str, window: Days, zone_id: str | None) -> tuple[DataFrame, list[str], validate.Tally] | None:
    """A feed's rows of a window, flagged by the table's rules, what they held as read, and their tally; None without files.

    Rows whose time doesn't parse stay, so that validation rejects them in sight of all.
    """
    raw = readers.read_source(spark, root, feed)
    if raw is None:
        log.warning("%s: nothing there", feed.name)
        return None
    rows = traced(raw, contract, feed, zone_id)
    rows = rows.where(within(F.col(TS), window, keep_null=True))
    bad_time = unparsed(contract, raw.columns)
    held = raw.columns
    if spec.levels:
        # A measure for each member and row: one odd member must not take the others of its instant along.
        (measure,) = spec.measures
        rows = rows.withColumn("bad_time_", bad_time)
        ids = [c for c in (TS, LOCAL, "quality", "quality_rank", "zone_id", "source", "source_file", "ingested_at", "bad_time_")]
        rows = reshape.unpivot(rows, ids, contract.selected(spec.levels), spec.member, measure.target)
        # The value as read takes the place of the cast one, for the rules to cast and judge.
        rows = rows.withColumn(measure.target, F.col(validate.RAW + measure.target)).drop(validate.RAW + measure.target)
        bad_time, held = F.col("bad_time_"), [c for c in rows.columns if c != "bad_time_"]
    flagged = validate.flagged(rows, spec)
    return flagged, held, validate.Tally(spec, feed.name, bad_time)


def load_table(spark: SparkSession, contract: Contract, table: str, root: str, target: str, window: Days, zone_id: str | None = None) -> Loaded:
    """Read a table's feeds, validate, quarantine, resolve duplicates and replace the window's months below target.

    Rejected rows are written first, to target/quarantine/<table>, and each feed's report is counted
    by that very pass. A feed with more than the contract's share of rejects then stops the run
    before the table is touched. Feeds without files are passed; if all are, that raises. The window
    must be whole months. Rows that several feeds tell are resolved by quality, time of ingestion and name.
    """
    spec = contract.tables[table]
    out = Loaded(table, window)
    feeds = [contract.sources[n] for n in (spec.feeds or contract.sources)]
    found = [x for f in feeds if (x := checked(spark, contract, spec, f, root, window, zone_id))]
    if not found:
        raise validate.ValidationError(f"{table}: no feed has files")
    rejects = [validate.quarantine(tally.watch(rows), spec, held) for rows, held, tally in found]
    out.n_quarantined = sinks.write_quarantine(reshape.union_sources(rejects), f"{target}/quarantine/{table}", window)
    out.reports = [tally.report() for _, _, tally in found]
    for r in out.reports:
        r.guard(contract.max_reject_ratio)
    rows = reshape.union_sources([projected(validate.valid(flagged, spec), spec) for flagged, _, _ in found], fill=True)
    order = dedupe.priority_order()
    if spec.dedup == "merge":
        rows = dedupe.by_merge(rows, spec.keys, order, [m.target for m in spec.measures])
    else:
        rows = dedupe.by_priority(rows, spec.keys, order)
    out.n_written = sinks.overwrite_months(rows, f"{target}/{table}", window, TS)
    return out


def with_overall(rows: DataFrame, weights: Mapping[str, float], measures: Sequence[str], zone_id: str, quality: str, rank: int) -> DataFrame:
    """rows by zone, and for every instant one of a zone that stands for all: weighted means over the zones that have a value."""
    weight = lookup(weights, F.col("zone_id"), 0.0)
    means = rows.groupBy(TS).agg(*[weighted_mean(F.col(m), weight).alias(m) for m in measures])
    own = {"zone_id": F.lit(zone_id), "quality": F.lit(quality), "quality_rank": F.lit(rank), "source_file": F.lit("weighted mean"), "ingested_at": F.current_timestamp()}
    means = means.withColumns({c: x.cast(rows.schema[c].dataType) for c, x in own.items() if c in rows.columns})
    return rows.unionByName(means, allowMissingColumns=True)


def build_marts(spark: SparkSession, silver: Mapping[str, str], target: str, request: Days, mix: marts.Mix, span: Reach | None = None, holidays: Sequence[str] = ()) -> dict[str, int]:
    """Read the trusted tables load, generation and weather, and replace the request's months of the three marts.

    What is read reaches further than what is written, by as much as features look back and ahead, and
    only its partitions are scanned. Returns the rows written by mart.
    """
    span = span or Reach()
    write, read = request.whole_months(), days_to_read(request, span)
    of = {n: readers.read_window(spark, silver[n], read) for n in ("load", "generation", "weather")}
    hours = marts.full_mix(of["load"], of["generation"], of["weather"], mix)
    mine = within(F.col("ts_hour"), write)
    days = marts.full_days(hours).where(F.col("date_local").between(F.lit(write.start), F.lit(write.end)))
    tables = {
        "mix_hourly": (hours.where(mine), "ts_hour"),
        "kpi_daily": (days, "date_local"),
        "features": (marts.features(hours, span, holidays).where(mine), "ts_hour"),
    }
    hours.persist()  # three marts of one read; hours are few beside what they sum up
    try:
        return {n: sinks.overwrite_months(sinks.stamp(df, write), f"{target}/{n}", write, ts) for n, (df, ts) in tables.items()}
    finally:
        hours.unpersist()
