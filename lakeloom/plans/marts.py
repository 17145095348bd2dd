"""Hourly, daily and feature tables over load, members and weather."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import cyclic, degree_days, ratio
from lakeloom.functions.temporal import calendar, is_holiday, local_time
from lakeloom.operators import reshape
from lakeloom.operators.aggregate import hourly
from lakeloom.operators.dedupe import quality_label
from lakeloom.operators.windows import at_offset, rolling
from lakeloom.plans.contract import Member
from lakeloom.plans.spans import Reach

BASE_C = 18.0


def hourly_members(df: DataFrame, members: Sequence[str], clean: Sequence[str], column: str, value: str) -> DataFrame:
    """A column for each listed member with its hourly mean, and totals, all in one aggregation pair."""
    by = df.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("ts_hour"), "zone_id", column).agg(F.avg(value).alias("v"))
    each = [F.max(F.when(F.col(column) == m, F.col("v"))).alias(f"{m}_mw") for m in members]
    return by.groupBy("ts_hour", "zone_id").agg(*each, F.sum("v").alias("total_mw"), F.sum(F.when(F.col(column).isin(*clean), F.col("v"))).alias("clean_mw"))


def hourly_mix(load: DataFrame, generation: DataFrame, weather: DataFrame, members: Sequence[str], clean: Sequence[str], zone: str) -> DataFrame:
    """Load by hour and zone with members, totals, ratios and the weather of one zone for all. Hours without load are left out."""
    base = hourly(load, "ts", ["zone_id"], ["load_mw"])
    mix = base.join(hourly_members(generation, members, clean, "member", "mw"), ["ts_hour", "zone_id"], "left")
    mix = mix.join(hourly(weather, "ts", [], ["temperature_c"]).drop("n_points"), "ts_hour", "left")
    return mix.withColumns(
        {
            "ts_local": local_time(F.col("ts_hour"), zone),
            "clean_pct": ratio(F.col("clean_mw"), F.col("total_mw"), 100.0),
            "balance_mw": F.col("total_mw") - F.col("load_mw"),
        }
    )


def daily_kpis(mix: DataFrame, null_safe: bool = True) -> DataFrame:
    """By local day and zone: energy, extremes, peak hour (earliest of equal ones), degree days. n_hours counts hours that have a load."""
    days = mix.withColumn("date_local", F.to_date("ts_local"))
    day = days.groupBy("date_local", "zone_id").agg(
        (F.sum("load_mw") / 1000).alias("energy_gwh"),
        F.max("load_mw").alias("peak_mw"),
        F.min("load_mw").alias("low_mw"),
        F.max_by("ts_hour", F.struct("load_mw", -F.unix_timestamp("ts_hour"))).alias("peak_hour"),
        (100 * F.try_divide(F.sum("clean_mw"), F.when(F.sum("total_mw") > 0, F.sum("total_mw")))).alias("clean_pct"),
        F.avg("temperature_c").alias("temperature_c"),
        F.count("load_mw").alias("n_hours"),
    )
    t = F.col("temperature_c")
    return day.withColumns({"hdd": degree_days(t, BASE_C, True, null_safe), "cdd": degree_days(t, BASE_C, False, null_safe)})


@dataclass(frozen=True)
class Mix:
    """What the hourly mart is made of: members by role, further means, ranks of quality, the zone of local days."""

    members: tuple[Member, ...]
    scale: Mapping[str, int]
    zone: str = "UTC"
    production: str = "production"
    storage: str = "storage"
    load_means: tuple[str, ...] = ("forecast_mw", "co2_g_kwh", "exchange_mw")
    weather_means: tuple[str, ...] = ("temperature_c",)
    weather_zone: str = "fr"
    unknown_rank: int = 99

    def names(self, keep=lambda m: True) -> list[str]:
        return [m.name for m in self.members if keep(m)]


def full_mix(load: DataFrame, generation: DataFrame, weather: DataFrame, mix: Mix) -> DataFrame:
    """Hours of load by zone, with members, totals by role, weather, forecast error and the worst quality of what went in.

    All tables are trusted ones: ts_utc, zone_id, quality_rank and load_mw, or member and mw, or
    weather's measures. Measures that load or weather lack are null. Totals leave out members of other
    roles than production and storage. Hours without load rows are left out.
    """
    hour = F.date_trunc("hour", F.col("ts_utc").cast("timestamp")).cast("timestamp_ntz").alias("ts_hour")
    mean = lambda df, c: (F.avg(c) if c in df.columns else F.lit(None).cast("double")).alias(c)
    base = load.groupBy(hour, "zone_id").agg(
        F.avg("load_mw").alias("load_mw"), F.count("load_mw").alias("n_points"), F.max("quality_rank").alias("rank_load_"), *[mean(load, c) for c in mix.load_means]
    )
    each = generation.groupBy(hour, "zone_id", "member").agg(F.avg("mw").alias("v"), F.max("quality_rank").alias("rank"))
    total = lambda keep: F.sum(F.when(F.col("member").isin(mix.names(keep)), F.col("v")))
    wide = reshape.pivot(
        each, ["ts_hour", "zone_id"], "member", mix.names(), F.col("v"),
        [
            total(lambda m: m.category == mix.production).alias("production_mw"),
            total(lambda m: m.category == mix.production and m.flag).alias("clean_mw"),
            total(lambda m: m.category == mix.storage).alias("storage_mw"),
            F.max("rank").alias("rank_generation_"),
        ],
    )
    wide = wide.withColumnsRenamed({n: f"{n}_mw" for n in mix.names()})
    air = weather.where(F.col("zone_id") == mix.weather_zone).groupBy(hour).agg(*[mean(weather, c) for c in mix.weather_means])
    out = base.join(wide, ["ts_hour", "zone_id"], "left").join(air, "ts_hour", "left")
    worst = F.coalesce(F.greatest("rank_load_", "rank_generation_"), F.lit(mix.unknown_rank))
    out = out.withColumns(
        {
            "ts_local": local_time(F.col("ts_hour"), mix.zone),
            "clean_pct": ratio(F.col("clean_mw"), F.col("production_mw"), 100.0),
            "forecast_error_mw": F.col("load_mw") - F.col("forecast_mw") if "forecast_mw" in mix.load_means else F.lit(None).cast("double"),
            "quality_rank": worst,
        }
    )
    return out.withColumn("quality", quality_label(F.col("quality_rank"), mix.scale, "unknown")).drop("rank_load_", "rank_generation_")


def full_days(hours: DataFrame, null_safe: bool = True) -> DataFrame:
    """By local day and zone, of full_mix(): energy, means, extremes, peak hour, forecast error, degree days, worst quality.

    n_hours counts the day's hours, n_load those with a load.
    """
    mean = lambda c: (F.avg(c) if c in hours.columns else F.lit(None).cast("double"))
    t = F.col("temperature_mean_c")
    made = F.sum("production_mw")
    day = hours.groupBy(F.to_date("ts_local").alias("date_local"), "zone_id").agg(
        (F.sum("load_mw") / 1000).alias("energy_gwh"),
        F.avg("load_mw").alias("load_mean_mw"),
        F.max("load_mw").alias("peak_mw"),
        F.hour(F.max_by("ts_local", F.struct("load_mw", -F.unix_timestamp("ts_hour")))).alias("peak_hour_local"),
        (100 * F.try_divide(F.sum("clean_mw"), F.when(made > 0, made))).alias("clean_pct"),
        mean("co2_g_kwh").alias("co2_mean_g_kwh"),
        mean("exchange_mw").alias("exchange_mean_mw"),
        F.avg("temperature_c").alias("temperature_mean_c"),
        F.min("temperature_c").alias("temperature_least_c"),
        F.max("temperature_c").alias("temperature_most_c"),
        F.avg(F.abs("forecast_error_mw")).alias("forecast_mae_mw"),
        F.count("*").alias("n_hours"),
        F.count("load_mw").alias("n_load"),
        F.max("quality_rank").alias("quality_rank"),
    )
    return day.withColumns({"hdd": degree_days(t, BASE_C, True, null_safe), "cdd": degree_days(t, BASE_C, False, null_safe)})


def features(mix: DataFrame, span: Reach, holidays: Sequence[str] = ()) -> DataFrame:
    """Rows with a target: lags, rolling statistics, calendar and weather. All offsets are of exact instants."""
    key, ts = ["zone_id"], "ts_hour"
    mean, std = rolling("load_mw", key, ts, span.rolling)
    parts = calendar(F.col("ts_local"))
    hour_sin, hour_cos = cyclic(parts["hour"], 24)
    t = F.col("temperature_c")
    out = mix.select(
        ts, "zone_id", "load_mw", "temperature_c", "ts_local",
        at_offset("load_mw", key, ts, span.lead).alias("target_mw"),
        *[at_offset("load_mw", key, ts, -h).alias(f"lag_{h}h") for h in span.lags],
        mean.alias("roll_mean"), std.alias("roll_std"),
        *[c.alias(n) for n, c in parts.items()], hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"),
        degree_days(t, BASE_C, True).alias("hdd"), degree_days(t, BASE_C, False).alias("cdd"),
        is_holiday(F.to_date("ts_local"), holidays).alias("is_holiday"),
    )
    return out.where(F.col("target_mw").isNotNull())
