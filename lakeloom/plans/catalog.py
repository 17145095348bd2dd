"""Catalogue of the engine's own queries over the driver's tables, each with SQL of its own where there is any."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.scalars import cyclic, degree_days, lookup, normalize_text, ratio
from lakeloom.functions.temporal import calendar, in_months, is_holiday, local_time, to_instant, within, within_local_days
from lakeloom.operators import aggregate as A
from lakeloom.operators import dedupe as D
from lakeloom.operators import forecast
from lakeloom.operators import reshape as R
from lakeloom.operators import validate as V
from lakeloom.operators import windows as W
from lakeloom.plans import jobs
from lakeloom.plans.contract import NULL_OUT, Contract, Dimension, Feed, Measure, Member, TableRules, load
from lakeloom.plans.marts import Mix, daily_kpis, features, hourly_mix
from lakeloom.plans.spans import Days, Reach
from lakeloom.sources import readers, sinks
from lakeloom.streaming import bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ZONE = "Europe/Paris"
KINDS = ("click", "error", "purchase", "signup", "view", "absent")
CLEAN = ("signup", "view")
QUALITY = {"f": 1, "o": 2, "p": 3}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a series: hourly means by event type."""
    return A.hourly(table(spark, sf_dir, "events"), "ts", ["event_type"], ["value"])


HOURS = "SELECT date_trunc('hour', ts) AS ts_hour, event_type, avg(value) AS value, count(value) AS n_points FROM events GROUP BY ALL"


@query(f"SELECT ts_hour, event_type, round(value, 8) AS value, n_points FROM ({HOURS})")
def hourly_resample(spark, d):
    return rounded(_hours(spark, d), "value")


@query(f"""SELECT ts_hour, {", ".join(f"round(max(CASE WHEN event_type = '{k}' THEN value END), 8) AS {k}" for k in KINDS)},
    round(sum(value), 8) AS total, round(sum(CASE WHEN event_type IN ('signup', 'view') THEN value END), 8) AS clean FROM ({HOURS}) GROUP BY ts_hour""")
def hourly_pivot(spark, d):
    totals = [F.sum("value").alias("total"), F.sum(F.when(F.col("event_type").isin(*CLEAN), F.col("value"))).alias("clean")]
    return rounded(R.pivot(_hours(spark, d), ["ts_hour"], "event_type", KINDS, F.col("value"), totals), *KINDS, "total", "clean")


@query("""SELECT event_type, round(sum(value), 8) AS total, round(sum(CASE WHEN user_id % 2 = 0 THEN value END), 8) AS even,
    CASE WHEN sum(value) > 0 THEN round(100 * sum(CASE WHEN user_id % 2 = 0 THEN value END) / sum(value), 8) END AS even_pct FROM events GROUP BY event_type""")
def category_totals(spark, d):
    even = F.sum(F.when(F.col("user_id") % 2 == 0, F.col("value")))
    out = table(spark, d, "events").groupBy("event_type").agg(F.sum("value").alias("total"), even.alias("even"), ratio(even, F.sum("value"), 100).alias("even_pct"))
    return rounded(out, "total", "even", "even_pct")


def _mix(spark, d):
    e = table(spark, d, "events")
    load = e.where("event_type = 'view'").select("ts", F.lit("fr").alias("zone_id"), F.col("value").alias("load_mw"))
    generation = e.where("event_type <> 'view'").select("ts", F.lit("fr").alias("zone_id"), F.col("event_type").alias("member"), F.col("value").alias("mw"))
    weather = e.where("event_type = 'error'").select("ts", (F.col("value") / 10).alias("temperature_c"))
    return hourly_mix(load, generation, weather, ("click", "purchase", "signup", "absent"), ("signup",), ZONE)


MIX = """
    SELECT l.ts_hour, 'fr' AS zone_id, l.load_mw, l.n_points, m.click_mw, m.purchase_mw, m.signup_mw, m.absent_mw, m.total_mw, m.clean_mw, w.temperature_c,
        (l.ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_local,
        CASE WHEN m.total_mw > 0 THEN 100 * m.clean_mw / m.total_mw END AS clean_pct, m.total_mw - l.load_mw AS balance_mw
    FROM (SELECT date_trunc('hour', ts) AS ts_hour, avg(value) AS load_mw, count(value) AS n_points FROM events WHERE event_type = 'view' GROUP BY 1) l
    LEFT JOIN (
        SELECT ts_hour, max(CASE WHEN event_type = 'click' THEN v END) AS click_mw, max(CASE WHEN event_type = 'purchase' THEN v END) AS purchase_mw,
            max(CASE WHEN event_type = 'signup' THEN v END) AS signup_mw, max(CASE WHEN event_type = 'absent' THEN v END) AS absent_mw,
            sum(v) AS total_mw, sum(CASE WHEN event_type = 'signup' THEN v END) AS clean_mw
        FROM (SELECT date_trunc('hour', ts) AS ts_hour, event_type, avg(value) AS v FROM events WHERE event_type <> 'view' GROUP BY ALL) GROUP BY 1) m USING (ts_hour)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS ts_hour, avg(value / 10) AS temperature_c FROM events WHERE event_type = 'error' GROUP BY 1) w USING (ts_hour)
"""
MIX_NUMBERS = ("load_mw", "click_mw", "purchase_mw", "signup_mw", "absent_mw", "total_mw", "clean_mw", "temperature_c", "clean_pct", "balance_mw")


@query(f"SELECT ts_hour, zone_id, n_points, ts_local, {', '.join(f'round({c}, 8) AS {c}' for c in MIX_NUMBERS)} FROM ({MIX})")
def hourly_mix_join(spark, d):
    return rounded(_mix(spark, d), *MIX_NUMBERS)


@query(f"SELECT count(temperature_c) AS n_matched, count(*) AS n_rows, round(count(temperature_c) / count(*), 6) AS coverage FROM ({MIX})")
def join_coverage(spark, d):
    return rounded(_mix(spark, d).agg(*A.coverage(F.col("temperature_c").isNotNull())), "coverage", digits=6)


@query(f"""SELECT ts_local::DATE AS date_local, zone_id, round(sum(load_mw) / 1000, 8) AS energy_gwh, round(max(load_mw), 8) AS peak_mw, round(min(load_mw), 8) AS low_mw,
    arg_max(ts_hour, (load_mw, -epoch(ts_hour))) AS peak_hour, CASE WHEN sum(total_mw) > 0 THEN round(100 * sum(clean_mw) / sum(total_mw), 8) END AS clean_pct,
    round(avg(temperature_c), 8) AS temperature_c, count(load_mw) AS n_hours,
    CASE WHEN avg(temperature_c) IS NOT NULL THEN round(greatest(18.0 - avg(temperature_c), 0), 8) END AS hdd,
    CASE WHEN avg(temperature_c) IS NOT NULL THEN round(greatest(avg(temperature_c) - 18.0, 0), 8) END AS cdd FROM ({MIX}) GROUP BY 1, 2""")
def local_day_kpi(spark, d):
    return rounded(daily_kpis(_mix(spark, d)), "energy_gwh", "peak_mw", "low_mw", "clean_pct", "temperature_c", "hdd", "cdd")


_LAG = "first(value) OVER (PARTITION BY event_type ORDER BY ts_hour RANGE BETWEEN INTERVAL {0} HOUR {1} AND INTERVAL {0} HOUR {1})"


@query(f"SELECT ts_hour, event_type, {', '.join(f'round({_LAG.format(h, "PRECEDING")}, 8) AS lag_{h}h' for h in (24, 48, 168))} FROM ({HOURS})")
def exact_lags(spark, d):
    out = W.offsets(_hours(spark, d), ["event_type"], "ts_hour", {f"lag_{h}h": ("value", -h) for h in (24, 48, 168)})
    return rounded(out.drop("value", "n_points"), "lag_24h", "lag_48h", "lag_168h")


@query(f"SELECT * FROM (SELECT ts_hour, event_type, round({_LAG.format(24, 'FOLLOWING')}, 8) AS target FROM ({HOURS})) WHERE target IS NOT NULL")
def target_lead(spark, d):
    out = W.offsets(_hours(spark, d), ["event_type"], "ts_hour", {"target": ("value", 24)})
    return rounded(out.drop("value", "n_points"), "target").where("target is not null")


_ROLL = "OVER (PARTITION BY event_type ORDER BY ts_hour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)"


@query(f"SELECT ts_hour, event_type, round(avg(value) {_ROLL}, 8) AS roll_mean, round(stddev_samp(value) {_ROLL}, 8) AS roll_std FROM ({HOURS})")
def rolling_24h(spark, d):
    mean, std = W.rolling("value", ["event_type"], "ts_hour", 24)
    return rounded(_hours(spark, d).select("ts_hour", "event_type", mean.alias("roll_mean"), std.alias("roll_std")), "roll_mean", "roll_std")


@query("""SELECT event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW), 8) AS roll_mean FROM events""")
def rolling_exclusive(spark, d):
    return rounded(W.rolling_open_rows(table(spark, d, "events"), "value", ["event_type"], "ts", 24, "roll_mean").select("event_id", "roll_mean"), "roll_mean")


@query("""SELECT event_id, hour(t)::INTEGER AS hour, (dayofweek(t) + 1)::INTEGER AS dow, month(t)::INTEGER AS month, (dayofweek(t) IN (0, 6))::INTEGER AS is_weekend,
    round(sin(hour(t) * 2 * pi() / 24), 6) AS hour_sin, round(cos(hour(t) * 2 * pi() / 24), 6) AS hour_cos,
    (t::DATE IN (DATE '2024-01-01'))::INTEGER AS is_holiday FROM (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS t FROM events)""")
def calendar_features(spark, d):
    e = table(spark, d, "events").withColumn("t", local_time(F.col("ts"), ZONE))
    parts = calendar(F.col("t"))
    hs, hc = cyclic(parts["hour"], 24)
    holiday = is_holiday(F.to_date("t"), ["2024-01-01"])
    return e.select("event_id", *[c.alias(n) for n, c in parts.items()], F.round(hs, 6).alias("hour_sin"), F.round(hc, 6).alias("hour_cos"), holiday.alias("is_holiday"))


@query("""SELECT event_id, CASE WHEN t IS NOT NULL THEN round(greatest(18.0 - t, 0), 8) END AS hdd, CASE WHEN t IS NOT NULL THEN round(greatest(t - 18.0, 0), 8) END AS cdd,
    round(greatest(18.0 - t, 0.0), 8) AS hdd_zero FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value / 10 END AS t FROM events)""")
def degree_features(spark, d):
    t = F.when(F.col("event_id") % 7 != 0, F.col("value") / 10)
    out = table(spark, d, "events").select(
        "event_id", degree_days(t, 18.0, True).alias("hdd"), degree_days(t, 18.0, False).alias("cdd"), degree_days(t, 18.0, True, null_safe=False).alias("hdd_zero")
    )
    return rounded(out, "hdd", "cdd", "hdd_zero")


ITEM_KEYS = ["l_orderkey", "l_linenumber"]
ITEM_RANK = {"r": 1, "a": 2, "n": 3}
ITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
ITEM_SQL = f"""CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_shipdate DESC NULLS LAST, {", ".join(ITEM_ORDER[1:])}"""


def _items(spark, d):
    items = table(spark, d, "lineitem").withColumn("quality_rank", D.quality_rank(F.col("l_returnflag"), ITEM_RANK, 3))
    return items, [F.col("quality_rank").asc(), F.col("l_shipdate").desc_nulls_last(), *[F.col(c).asc() for c in ITEM_ORDER[1:]]]


@query(f"""SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ITEM_SQL}) AS n FROM lineitem) WHERE n = 1""")
def dedupe_priority(spark, d):
    items, order = _items(spark, d)
    return D.by_priority(items, ITEM_KEYS, order).select(*ITEM_KEYS, "l_returnflag", "l_partkey", "l_quantity")


_HOLES = "CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS q, CASE WHEN l_suppkey % 2 = 0 THEN l_extendedprice END AS p"


@query(f"""SELECT l_orderkey, l_linenumber, l_returnflag, first_value(q IGNORE NULLS) OVER w AS q, first_value(p IGNORE NULLS) OVER w AS p FROM (SELECT *, {_HOLES} FROM lineitem)
    WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY {ITEM_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ITEM_SQL}) = 1""")
def dedupe_merge(spark, d):
    items, order = _items(spark, d)
    items = items.withColumns({"q": F.when(F.col("l_partkey") % 3 != 0, F.col("l_quantity")), "p": F.when(F.col("l_suppkey") % 2 == 0, F.col("l_extendedprice"))})
    return D.by_merge(items, ITEM_KEYS, order, ["q", "p"]).select(*ITEM_KEYS, "l_returnflag", "q", "p")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 ELSE 99 END AS quality_rank, lower(o_orderstatus) AS quality FROM orders""")
def quality_rank_label(spark, d):
    rank = D.quality_rank(F.col("o_orderstatus"), QUALITY)
    return table(spark, d, "orders").select("o_orderkey", rank.alias("quality_rank"), D.quality_label(rank, QUALITY).alias("quality"))


ORDER_SPEC = TableRules(
    "orders_clean",
    keys=("o_orderkey",),
    measures=(
        Measure("price", ("o_totalprice_text",), low=20_000, high=400_000),
        Measure("score", ("score_text",), low=0, high=80, policy=NULL_OUT),
    ),
    dimensions=(Dimension("status", ("o_orderstatus",), ("F", "O")),),
    not_null=("cust",),
    drop_if_all_null=("score",),
)
_FAULTY = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cust, o_orderstatus,
    CASE WHEN o_orderkey % 13 = 0 THEN 'ABC' WHEN o_orderkey % 17 = 0 THEN ' ' ELSE o_totalprice::VARCHAR END AS o_totalprice_text,
    (o_orderkey % 100)::VARCHAR AS score_text FROM orders"""
_FLAGGED = f"""SELECT *, try_cast(o_totalprice_text AS DOUBLE) AS price, score_text::DOUBLE AS score,
    CASE WHEN cust IS NULL THEN 'null_key' WHEN try_cast(o_totalprice_text AS DOUBLE) IS NULL AND trim(o_totalprice_text) <> '' THEN 'cast_failed'
        WHEN o_orderstatus NOT IN ('F', 'O') THEN 'unexpected_value'
        WHEN try_cast(o_totalprice_text AS DOUBLE) < 20000 OR try_cast(o_totalprice_text AS DOUBLE) > 400000 THEN 'out_of_range' END AS reason FROM ({_FAULTY})"""


def _faulty(spark, d):
    key = F.col("o_orderkey")
    text = F.when(key % 13 == 0, "ABC").when(key % 17 == 0, " ").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(key % 11 != 0, F.col("o_custkey")).alias("cust"), "o_orderstatus", text.alias("o_totalprice_text"), (key % 100).cast("string").alias("score_text")
    )


def _flagged(spark, d):
    return V.flagged(_faulty(spark, d), ORDER_SPEC)


@query(f"""SELECT o_orderkey, reason, CASE reason WHEN 'null_key' THEN 'cust' WHEN 'unexpected_value' THEN 'status' WHEN 'cast_failed' THEN 'price' WHEN 'out_of_range' THEN 'price' END AS "column" FROM ({_FLAGGED})""")
def validate_flag(spark, d):
    return _flagged(spark, d).select("o_orderkey", F.col(f"{V.REASON}.reason").alias("reason"), F.col(f"{V.REASON}.column").alias("column"))


@query(f"""SELECT reason, CASE reason WHEN 'null_key' THEN 'cust' WHEN 'unexpected_value' THEN 'status' WHEN 'cast_failed' THEN 'price' WHEN 'out_of_range' THEN 'price' END AS "column", count(*) AS n FROM ({_FLAGGED}) GROUP BY ALL""")
def validate_histogram(spark, d):
    return V.histogram(_flagged(spark, d))


@query(f"SELECT o_orderkey, o_orderstatus AS status, price, CASE WHEN score <= 80 THEN score END AS score FROM ({_FLAGGED}) WHERE reason IS NULL AND score <= 80")
def validate_valid(spark, d):
    return V.valid(_flagged(spark, d), ORDER_SPEC).select("o_orderkey", "status", "price", "score")


@query(f"SELECT 'orders_clean' AS table_name, reason AS reject_reason, o_orderkey, CASE WHEN cust IS NULL THEN 0 ELSE 1 END AS has_cust FROM ({_FLAGGED}) WHERE reason IS NOT NULL")
def validate_rejects(spark, d):
    rows = V.quarantine(_flagged(spark, d), ORDER_SPEC, ["o_orderkey", "cust", "o_orderstatus", "o_totalprice_text"])
    payload = F.from_json("payload", "o_orderkey bigint, cust bigint")
    return rows.select("table_name", "reject_reason", payload["o_orderkey"].alias("o_orderkey"), payload["cust"].isNotNull().cast("int").alias("has_cust"))


@query(f"SELECT count(*) AS n_input, count(reason) AS n_rejected, round(count(reason) / count(*), 6) AS reject_ratio FROM ({_FLAGGED})")
def reject_ratio(spark, d):
    bad = F.col(V.REASON).isNotNull()
    return _flagged(spark, d).agg(F.count("*").alias("n_input"), F.count_if(bad).alias("n_rejected"), F.round(F.count_if(bad) / F.count("*"), 6).alias("reject_ratio"))


ITEM_SPEC = TableRules("items", keys=("l_orderkey",), measures=(Measure("quantity", ("l_quantity",), low=5, high=45, policy=NULL_OUT), Measure("kg", ("l_quantity",), factor=0.5, low=1, high=20, policy=NULL_OUT)), drop_if_all_null=("quantity", "kg"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS quantity, CASE WHEN l_quantity * 0.5::DOUBLE BETWEEN 1 AND 20 THEN l_quantity * 0.5::DOUBLE END AS kg FROM lineitem""")
def null_out(spark, d):
    return V.null_out(V.typed(table(spark, d, "lineitem"), ITEM_SPEC), ITEM_SPEC).select("l_orderkey", "l_linenumber", "l_partkey", "quantity", "kg")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 OR l_quantity * 0.5 BETWEEN 1 AND 20""")
def drop_empty(spark, d):
    rows = V.null_out(V.typed(table(spark, d, "lineitem"), ITEM_SPEC), ITEM_SPEC)
    return V.drop_empty(rows, ITEM_SPEC).select("l_orderkey", "l_linenumber", "l_partkey")


MEMBERS = (
    Member("quantity", ("L-Quantity",), "primary", "volume", True),
    Member("price", ("l_extendedprice",), "primary", "money"),
    Member("discount", ("l_discount",), "detail", "money", parent="price"),
    Member("tax", ("l_tax",), "detail", "money", parent="price"),
)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, member, value, level AS member_level, category AS member_category, flag AS member_flag, parent AS member_parent FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS member, l_quantity AS value, 'primary' AS level, 'volume' AS category, true AS flag, NULL::VARCHAR AS parent FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'price', l_extendedprice, 'primary', 'money', false, NULL FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount, 'detail', 'money', false, 'price' FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax', l_tax, 'detail', 'money', false, 'price' FROM lineitem) WHERE value IS NOT NULL""")
def unpivot_measures(spark, d):
    return R.unpivot(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], MEMBERS, "member", "value", keep_bad=False)


@query("""SELECT member, count(*) AS n, round(sum(v), 2) AS total FROM (SELECT 'quantity' AS member, l_quantity AS v FROM lineitem UNION ALL SELECT 'price', l_extendedprice FROM lineitem) GROUP BY member""")
def hierarchy_filter(spark, d):
    chosen = Contract({}, {}, {}, MEMBERS).selected(["primary"])
    rows = R.unpivot(table(spark, d, "lineitem"), ["l_orderkey"], chosen, "member", "value", keep_bad=False)
    return rounded(rows.groupBy("member").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total", digits=2)


@query("""SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding)))::INTEGER AS i, unnest([1, 2]) AS short FROM embeddings""")
def arrays_explode(spark, d):
    e = table(spark, d, "embeddings")
    arrays = {"x": F.col("embedding"), "i": F.sequence(F.lit(0), F.size("embedding") - 1), "short": F.array(F.lit(1), F.lit(2))}
    return R.explode_parallel(e, arrays, ["vec_id"])


@query("""SELECT r_name, round(sum(CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END * w) / nullif(sum(CASE WHEN c_custkey % 5 <> 0 THEN w END), 0), 8) AS mean
    FROM (SELECT *, CASE n_nationkey % 4 WHEN 0 THEN 2.0::DOUBLE WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE 0.0 END AS w FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY r_name""")
def weighted_mean(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    value = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    weight = lookup({0: 2.0, 1: 1.0, 2: 0.5}, F.col("n_nationkey") % 4)
    return rounded(rows.groupBy("r_name").agg(A.weighted_mean(value, weight).alias("mean")), "mean")


@query("""SELECT o_orderkey, o_totalprice, 'a' AS source, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_totalprice, 'b', o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def union_sources(spark, d):
    o = table(spark, d, "orders")
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", F.lit("a").alias("source"))
    b = o.where("o_orderstatus <> 'F'").select(F.lit("b").alias("source"), "o_totalprice", "o_orderkey", F.col("o_orderpriority").alias("note"))
    return R.union_sources([a, b], fill=True).select("o_orderkey", "o_totalprice", "source", "note")


@query("""SELECT doc_id, trim(regexp_replace(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9]+', '_', 'g'), '_') AS name FROM documents""")
def normalize_names(spark, d):
    return table(spark, d, "documents").select("doc_id", normalize_text(F.col("text")).alias("name"))


@query("""SELECT event_id, ts AS ts_utc FROM events""")
def utc_normalize(spark, d):
    # Text in three forms: local time with offset, with Z, and local time without either.
    e = table(spark, d, "events")
    local = local_time(F.col("ts"), ZONE).cast("string")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(local, F.lit("+01:00"))).when(F.col("event_id") % 3 == 1, F.concat(F.col("ts").cast("string"), F.lit("Z"))).otherwise(local)
    return e.select("event_id", to_instant(text, ZONE).cast("timestamp_ntz").alias("ts_utc"))


PAST = Days.between("1996-11-15", "1997-02-10")


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-11-15' AND o_orderdate < TIMESTAMP '1997-02-11'""")
def window_filter(spark, d):
    return table(spark, d, "orders").where(within(F.col("o_orderdate"), PAST)).select("o_orderkey", "o_orderdate")


@query("""SELECT event_id FROM events WHERE ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris')::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'""")
def local_day_filter(spark, d):
    return table(spark, d, "events").where(within_local_days(F.col("ts"), ZONE, Days.between("2024-01-05", "2024-01-08"))).select("event_id")


@query("""SELECT o_orderkey, o_orderdate, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month FROM orders WHERE o_orderdate >= TIMESTAMP '1996-11-15' AND o_orderdate < TIMESTAMP '1997-02-11'""")
def partition_prune(spark, d):
    path = _scratch(spark) + "/orders"
    sinks.overwrite_partitions(sinks.with_partitions(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate"), path)
    return readers.read_window(spark, path, PAST, "o_orderdate")


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def json_envelope(spark, d):
    made = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    lines = made.select(readers.envelope(["event_id", "k"], {"source": "events"}).alias("raw_value"), F.lit("2024-02-01").alias("bronze_ingested_at"))
    path = _scratch(spark) + "/envelopes"
    lines.write.json(path)
    got = readers.read_envelope(spark, path, {})
    return got.select(F.col("event_id").cast("long").alias("event_id"), F.col("k").cast("long").alias("k"))


@query("""SELECT round(corr(l_extendedprice, l_quantity), 6) AS correlation, round(regr_slope(l_extendedprice, l_quantity) FILTER (WHERE l_quantity < 18), 3) AS slope FROM lineitem""")
def corr_slope(spark, d):
    y, x = "l_extendedprice", "l_quantity"
    return table(spark, d, "lineitem").agg(F.round(A.correlation(y, x), 6).alias("correlation"), F.round(A.slope(y, x, F.col(x) < 18), 3).alias("slope"))


@query("""SELECT dayofweek(t) IN (0, 6) AS weekend, hour(t)::INTEGER AS hour, round(avg(value), 8) AS mean, round(stddev_samp(value), 8) AS std FROM (SELECT value, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS t FROM events) GROUP BY ALL""")
def profile_by_hour(spark, d):
    return rounded(A.profile(table(spark, d, "events"), local_time(F.col("ts"), ZONE), "value"), "mean", "std")


@query("""SELECT event_type, round(sum(value), 8) AS total, round(100 * sum(value) / (SELECT sum(value) FROM events), 8) AS share_pct FROM events GROUP BY event_type""")
def share_of_total(spark, d):
    return rounded(A.share_of_total(table(spark, d, "events"), "event_type", "value"), "total", "share_pct")


@query("""SELECT ts::DATE AS day, arg_max(event_id, (value, -event_id)) AS top, arg_min(event_id, (value, event_id)) AS low FROM events GROUP BY 1""")
def argmax_day(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(*A.extremes("event_id", "value"))


@query("""SELECT event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) = 1""")
def top_row(spark, d):
    return W.top_row(table(spark, d, "events"), ["event_type"], [F.col("value").desc_nulls_last(), F.col("event_id").asc()]).select("event_type", "event_id", "value")


@query("""SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 8""")
def top_values(spark, d):
    return table(spark, d, "events").orderBy(F.desc("value"), "event_id").limit(8).select("event_id", "value")


@query("""SELECT round(sum(value), 3) AS total, max(value) AS top, round(avg(value), 6) AS mean, count(*) AS n FROM events""")
def headline_totals(spark, d):
    return rounded(rounded(table(spark, d, "events").agg(*A.headline("value")), "total", digits=3), "mean", digits=6)


@query("""SELECT CASE WHEN o_totalprice = 500000 THEN 59 ELSE greatest(-1, least(60, floor((o_totalprice - 0.0::DOUBLE) / (500000.0::DOUBLE / 60)))) END::INTEGER AS bin, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def histogram(spark, d):
    return A.histogram(table(spark, d, "orders"), "o_totalprice", 0.0, 500_000.0, 60)


_PRED = f"SELECT * FROM (SELECT *, {_LAG.format(24, 'PRECEDING')} AS lag FROM ({HOURS})) WHERE lag IS NOT NULL AND value IS NOT NULL"
_ERRORS = """round(avg(abs(lag - value)), 8) AS mae, round(sqrt(avg((lag - value) ** 2)), 8) AS rmse, round(100 * avg(CASE WHEN value <> 0 THEN abs((lag - value) / value) END), 2) AS mape_pct, round(avg(lag - value), 8) AS bias, count(lag - value) AS n"""


def _predicted(spark, d):
    return W.offsets(_hours(spark, d), ["event_type"], "ts_hour", {"lag": ("value", -24)}).where("lag is not null and value is not null")


@query(f"SELECT event_type, {_ERRORS} FROM ({_PRED}) GROUP BY event_type")
def regression_metrics(spark, d):
    out = _predicted(spark, d).groupBy("event_type").agg(*A.error_metrics("value", "lag"))
    return rounded(rounded(out, "mae", "rmse", "bias"), "mape_pct", digits=2)


@query(f"SELECT hour((ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris')::INTEGER AS hour, round(avg(abs(lag - value)), 8) AS mae, count(*) AS n FROM ({_PRED}) GROUP BY 1")
def error_by_hour(spark, d):
    rows = _predicted(spark, d).withColumn("hour", F.hour(local_time(F.col("ts_hour"), ZONE)))
    return rounded(rows.groupBy("hour").agg(F.avg(F.abs(F.col("lag") - F.col("value"))).alias("mae"), F.count("*").alias("n")), "mae")


@query("""SELECT count(*) AS n, count(*) FILTER (WHERE ts < (SELECT quantile_disc(ts, 0.8) FROM events)) AS n_train FROM events""")
def chrono_split(spark, d):
    train, test = forecast.split(table(spark, d, "events"), "ts", 0.8)
    both = train.select(F.lit(1).alias("t")).unionAll(test.select(F.lit(0).alias("t")))
    return both.agg(F.count("*").alias("n"), F.sum("t").alias("n_train"))


_FEATURE_SQL = """first(load_mw) OVER (ORDER BY ts_hour RANGE BETWEEN INTERVAL {0} HOUR {1} AND INTERVAL {0} HOUR {1})"""


@query(f"""SELECT * FROM (SELECT ts_hour, zone_id, round({_FEATURE_SQL.format(24, "FOLLOWING")}, 8) AS target_mw, round({_FEATURE_SQL.format(24, "PRECEDING")}, 8) AS lag_24h,
    round({_FEATURE_SQL.format(168, "PRECEDING")}, 8) AS lag_168h, round(avg(load_mw) OVER (ORDER BY ts_hour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW), 8) AS roll_mean,
    hour(ts_local)::INTEGER AS hour, (ts_local::DATE = DATE '2024-01-01')::INTEGER AS is_holiday FROM ({MIX})) WHERE target_mw IS NOT NULL""")
def ml_features(spark, d):
    out = features(_mix(spark, d), Reach(), ["2024-01-01"])
    return rounded(out, "target_mw", "lag_24h", "lag_168h", "roll_mean").select("ts_hour", "zone_id", "target_mw", "lag_24h", "lag_168h", "roll_mean", "hour", "is_holiday")


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir. Where that is unset, a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakeloom-")
    return f"{root.rstrip('/')}/lakeloom-{uuid.uuid4().hex}"


@query("""SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, DATE '1996-11-01' AS window_start, DATE '1997-02-28' AS window_end
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-11-01' AND o_orderdate < TIMESTAMP '1997-03-01'""")
def stamped_write_readback(spark, d):
    path, window = _scratch(spark) + "/stamped", PAST.whole_months()
    rows = table(spark, d, "orders").where(within(F.col("o_orderdate"), window))
    sinks.overwrite_months(sinks.stamp(rows, window), path, window, "o_orderdate")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "year", "month", "window_start", "window_end")


@query("""SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-11-01' AND o_orderdate < TIMESTAMP '1997-03-01' THEN 2 ELSE 1 END AS version FROM orders""")
def overwrite_idempotence(spark, d):
    path, window = _scratch(spark) + "/versions", PAST.whole_months()
    rows = sinks.with_partitions(table(spark, d, "orders"), "o_orderdate")
    sinks.overwrite_partitions(rows.withColumn("version", F.lit(1)), path)
    for _ in range(2):  # a replay changes nothing
        sinks.overwrite_months(rows.where(in_months(window)).withColumn("version", F.lit(2)), path, window, "o_orderdate")
    return spark.read.parquet(path).select("o_orderkey", "version")


@query("""SELECT p_partkey, p_name, round(p_retailprice, 2) AS p_retailprice FROM part""")
def csv_roundtrip(spark, d):
    root = _scratch(spark)
    table(spark, d, "part").select("p_partkey", "p_name", F.round("p_retailprice", 2).alias("P-RetailPrice")).write.option("header", "true").option("sep", ";").csv(f"{root}/part")
    source = Feed("part", "part", "csv", required=("p_partkey", "p_retailprice"))
    spec = TableRules("part", keys=("p_partkey",), measures=(Measure("price", ("p_retailprice",)),))
    got = V.typed(readers.read_source(spark, root, source), spec)
    return got.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.col("price").alias("p_retailprice"))


@query("""SELECT n_nationkey::INTEGER AS n_nationkey, n_name FROM nation""")
def xml_points(spark, d):
    path = _scratch(spark) + "/nations"
    table(spark, d, "nation").select("n_nationkey", "n_name").write.option("rowTag", "Point").option("rootTag", "Document").xml(path)
    return readers.read_xml(spark, path, {"row": "Point", "schema": "n_nationkey int, n_name string"})


@query("""SELECT c_custkey, i::INTEGER AS i, c_acctbal + i AS value FROM customer, unnest([0, 1, 2]) AS u(i)""")
def array_documents(spark, d):
    path = _scratch(spark) + "/documents"
    c = table(spark, d, "customer")
    hourly = F.struct(F.array(*[F.lit(i) for i in range(3)]).alias("time"), F.array(*[F.col("c_acctbal") + i for i in range(3)]).alias("value"))
    c.select(F.pmod("c_custkey", F.lit(3)).alias("city"), "c_custkey", hourly.alias("hourly")).write.partitionBy("city").json(path)
    got = readers.read_arrays(spark, f"{path}/city=*", {"base": path, "multiLine": "false"})
    rows = R.explode_parallel(got, {"i": F.col("hourly.time"), "value": F.col("hourly.value")}, ["c_custkey"])
    return rows.select("c_custkey", F.col("i").cast("int").alias("i"), "value")


@query("""SELECT event_id, event_type AS message_key, ts::DATE::VARCHAR AS day FROM events""")
def stream_bronze(spark, d):
    root = _scratch(spark)
    e = table(spark, d, "events")
    body = F.to_json(F.struct("event_id", F.to_date("ts").alias("day")))
    e.select(F.col("event_type").alias("key"), body.alias("value"), F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp")).write.json(f"{root}/in")
    for _ in range(2):  # the second run has nothing new
        bronze.RawSink(f"{root}/out", f"{root}/checkpoint").drain(bronze.raw_records(bronze.file_stream(spark, f"{root}/in"))).awaitTermination()
    out = spark.read.schema("raw_value string, message_key string").json(f"{root}/out")
    return out.select(F.get_json_object("raw_value", "$.event_id").cast("long").alias("event_id"), "message_key", F.get_json_object("raw_value", "$.day").alias("day"))


JOB = load(
    {
        "qualities": {"definitive": 1, "consolidated": 2, "realtime": 3},
        "instants": ["stamp"],
        "quality_columns": ["nature"],
        "quality_texts": {"checked": "definitive", "preliminary_data": "consolidated"},
        "max_reject_ratio": 0.75,
        "sources": {
            "final": {"path": "final", "format": "csv", "default_quality": "consolidated", "required": ["stamp", "order_key"]},
            "live": {"path": "live", "format": "json_envelope", "default_quality": "realtime"},
            "absent": {"path": "absent", "format": "csv"},
        },
        "tables": {
            "priced": {
                "keys": ["ts_utc", "unit"],
                "lineage": ["ts_utc", "ts_local", "zone_id", "source", "quality", "quality_rank", "ingested_at"],
                "not_null": ["ts_utc"],
                "drop_if_all_null": ["price", "score"],
                "dedup": "merge",
                "dimensions": [{"target": "unit", "candidates": ["order_key"]}, {"target": "status", "candidates": ["o_orderstatus"], "allowed": ["F", "O"]}],
                "measures": [{"target": "price", "candidates": ["total_price"], "low": 20000, "high": 400000}, {"target": "score", "low": 0, "high": 80, "policy": "null_out"}],
            },
            "parts": {
                "keys": ["ts_utc", "source_file", "source", "member", "zone_id"],
                "lineage": ["ts_utc", "zone_id", "source", "source_file", "quality", "quality_rank", "ingested_at"],
                "feeds": ["final"],
                "levels": ["primary"],
                "measures": [{"target": "amount", "low": 0, "high": 400000}],
            },
        },
        "members": [
            {"name": "total", "candidates": ["Total Price"], "category": "money", "flag": True},
            {"name": "units", "candidates": ["Order Key"], "category": "count"},
            {"name": "half", "candidates": ["Half Price"], "level": "detail", "parent": "total"},
        ],
    }
)
_FEEDS = """
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 131 <> 0 THEN o_orderdate END AS ts, o_orderstatus AS s, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price,
        NULL::DOUBLE AS score, 'final' AS source, CASE o_orderkey % 4 WHEN 0 THEN 'definitive' ELSE 'consolidated' END AS quality FROM orders
    UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 131 <> 0 THEN o_orderdate END, o_orderstatus, o_totalprice + 1, (o_orderkey % 100)::DOUBLE, 'live', 'realtime' FROM orders WHERE o_orderkey % 3 = 0"""
_JUDGED = f"""SELECT *, CASE WHEN ts IS NULL THEN 'null_key:ts_utc' WHEN s NOT IN ('F', 'O') THEN 'unexpected_value:status' WHEN price < 20000 OR price > 400000 THEN 'out_of_range:price' END AS reason
    FROM ({_FEEDS}) WHERE ts IS NULL OR (ts >= TIMESTAMP '1996-11-01' AND ts < TIMESTAMP '1997-03-01')"""


def _raw_feeds(spark, d):
    """Two raw feeds with faults: one complete but coarse, one early."""
    root, k = _scratch(spark), F.col("o_orderkey")
    o = table(spark, d, "orders").withColumn("stamp", F.when(k % 131 == 0, "nope").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))))
    nature = F.when(k % 4 == 0, "Checked!").when(k % 4 == 1, "PRELIMINARY data")
    price = F.when(k % 5 != 0, F.col("o_totalprice")).cast("string")
    final = o.select(k.alias("Order Key"), F.col("stamp").alias("Stamp"), "o_orderstatus", price.alias("Total Price"), nature.alias("Nature"))
    final.write.option("header", "true").option("sep", ";").csv(f"{root}/final")
    live = o.where(k % 3 == 0).withColumns({"order_key": k, "total_price": F.col("o_totalprice") + 1, "score": k % 100})
    body = readers.envelope(["order_key", "stamp", "o_orderstatus", "total_price", "score"], {"source": "orders"})
    live.select(body.alias("raw_value"), F.lit("2024-02-01").alias("bronze_ingested_at")).write.json(f"{root}/live")
    return root


@query(f"""SELECT ts AS ts_utc, k::VARCHAR AS unit, s AS status, round(first_value(price IGNORE NULLS) OVER w, 6) AS price, first_value(sc IGNORE NULLS) OVER w AS score, source, quality, rank AS quality_rank,
        year(ts)::INTEGER AS year, month(ts)::INTEGER AS month
    FROM (SELECT *, CASE WHEN score <= 80 THEN score END AS sc, CASE quality WHEN 'definitive' THEN 1 WHEN 'consolidated' THEN 2 ELSE 3 END AS rank FROM ({_JUDGED}) WHERE reason IS NULL)
    WHERE price IS NOT NULL OR sc IS NOT NULL
    WINDOW w AS (PARTITION BY ts, k ORDER BY rank, source ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    QUALIFY row_number() OVER (PARTITION BY ts, k ORDER BY rank, source) = 1""")
def silver_load_job(spark, d):
    root, window = _raw_feeds(spark, d), PAST.whole_months()
    for _ in range(2):  # a replay changes nothing
        jobs.load_table(spark, JOB, "priced", root, f"{root}/silver", window)
    got = readers.read_window(spark, f"{root}/silver/priced", window)
    got = got.select(F.col("ts_utc").cast("timestamp_ntz").alias("ts_utc"), "unit", "status", "price", "score", "source", "quality", "quality_rank", "year", "month")
    return rounded(got, "price", digits=6)


@query(f"""SELECT source AS feed, coalesce(reason, 'valid') AS reason, count(*) AS n FROM ({_JUDGED}) GROUP BY ALL
    UNION ALL SELECT source, 'unparsed time', count(*) FILTER (WHERE ts IS NULL) FROM ({_JUDGED}) GROUP BY ALL""")
def silver_load_report(spark, d):
    root = _raw_feeds(spark, d)
    done = jobs.load_table(spark, JOB, "priced", root, f"{root}/silver", PAST.whole_months())
    rows = [(r.feed, name, n) for r in done.reports for name, n in [*r.reasons.items(), ("valid", r.n_input - r.n_rejected), ("unparsed time", r.n_unparsed)]]
    return spark.createDataFrame(rows, "feed string, reason string, n long")


@query(f"""SELECT source, reason, k::VARCHAR AS unit FROM ({_JUDGED}) WHERE reason IS NOT NULL""")
def silver_quarantine_job(spark, d):
    root, window = _raw_feeds(spark, d), PAST.whole_months()
    jobs.load_table(spark, JOB, "priced", root, f"{root}/silver", window)
    rows = spark.read.parquet(f"{root}/silver/quarantine/priced")
    unit = F.coalesce(F.get_json_object("payload", "$['Order Key']"), F.get_json_object("payload", "$.order_key"))
    return rows.select("source", F.concat_ws(":", "reject_reason", "reject_column").alias("reason"), unit.alias("unit"))


@query("""SELECT ts AS ts_utc, member, category AS member_category, flag AS member_flag, round(max(v), 6) AS amount FROM (
        SELECT ts, 'total' AS member, 'money' AS category, true AS flag, price AS v FROM feeds UNION ALL SELECT ts, 'units', 'count', false, k::DOUBLE FROM feeds)
    WHERE v BETWEEN 0 AND 400000 GROUP BY ALL""".replace("feeds", f"(SELECT * FROM ({_FEEDS}) WHERE source = 'final' AND ts >= TIMESTAMP '1996-11-01' AND ts < TIMESTAMP '1997-03-01')"))
def silver_members_job(spark, d):
    # Orders of one instant are one key here; the largest amount stands for them.
    root, window = _raw_feeds(spark, d), PAST.whole_months()
    spec = JOB.tables["parts"]
    flagged, _, _ = jobs.checked(spark, JOB, spec, JOB.sources["final"], root, window, "fr")
    rows = jobs.projected(V.valid(flagged, spec), spec)
    got = rows.groupBy(F.col("ts_utc").cast("timestamp_ntz").alias("ts_utc"), "member", "member_category", "member_flag").agg(F.max("amount").alias("amount"))
    return rounded(got.where("ts_utc is not null"), "amount", digits=6)


GOLD = Mix(
    members=(Member("click", category="production", flag=True), Member("purchase", category="production"), Member("signup", category="storage"), Member("absent", category="production")),
    scale={"definitive": 1, "consolidated": 2, "realtime": 3}, zone=ZONE, load_means=("forecast_mw", "co2_g_kwh"),
)
MONTH = Days.between("2024-01-03", "2024-01-20")
_GOLD_MIX = """
    SELECT l.ts_hour, 'fr' AS zone_id, l.load_mw, l.n_points, l.forecast_mw, m.click_mw, m.purchase_mw, m.signup_mw, m.absent_mw, m.production_mw, m.clean_mw, m.storage_mw, w.temperature_c,
        (l.ts_hour AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_local, CASE WHEN m.production_mw > 0 THEN 100 * m.clean_mw / m.production_mw END AS clean_pct,
        l.load_mw - l.forecast_mw AS forecast_error_mw, coalesce(greatest(l.rank, m.rank), 99)::INTEGER AS quality_rank,
        CASE coalesce(greatest(l.rank, m.rank), 99) WHEN 1 THEN 'definitive' WHEN 2 THEN 'consolidated' WHEN 3 THEN 'realtime' ELSE 'unknown' END AS quality
    FROM (SELECT date_trunc('hour', ts) AS ts_hour, avg(value) AS load_mw, count(value) AS n_points, avg(CASE WHEN event_id % 2 = 0 THEN value * 0.9::DOUBLE END) AS forecast_mw, max(event_id % 3 + 1) AS rank
        FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2023-12-24' AND ts < TIMESTAMP '2024-02-02' GROUP BY 1) l
    LEFT JOIN (
        SELECT ts_hour, max(CASE WHEN event_type = 'click' THEN v END) AS click_mw, max(CASE WHEN event_type = 'purchase' THEN v END) AS purchase_mw, max(CASE WHEN event_type = 'signup' THEN v END) AS signup_mw,
            max(CASE WHEN event_type = 'absent' THEN v END) AS absent_mw, sum(CASE WHEN event_type IN ('click', 'purchase') THEN v END) AS production_mw, sum(CASE WHEN event_type = 'click' THEN v END) AS clean_mw,
            sum(CASE WHEN event_type = 'signup' THEN v END) AS storage_mw, max(rank) AS rank
        FROM (SELECT date_trunc('hour', ts) AS ts_hour, event_type, avg(value) AS v, max(event_id % 4 + 1) AS rank FROM events WHERE event_type <> 'view' GROUP BY ALL) GROUP BY 1) m USING (ts_hour)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS ts_hour, avg(value / 10) AS temperature_c FROM events WHERE event_type = 'error' AND event_id % 2 = 0 GROUP BY 1) w USING (ts_hour)
"""
_GOLD_NUMBERS = ("load_mw", "forecast_mw", "click_mw", "purchase_mw", "signup_mw", "absent_mw", "production_mw", "clean_mw", "storage_mw", "temperature_c", "clean_pct", "forecast_error_mw")


def _gold(spark, d) -> str:
    """The three marts of a month, from trusted tables made of events; returns their folder."""
    root, e, n = _scratch(spark), table(spark, d, "events"), F.col("event_id")
    ts = F.col("ts").cast("timestamp").alias("ts_utc")
    made = {
        "load": e.where("event_type = 'view'").select(ts, F.lit("fr").alias("zone_id"), F.col("value").alias("load_mw"), F.when(n % 2 == 0, F.col("value") * 0.9).alias("forecast_mw"), (n % 3 + 1).cast("int").alias("quality_rank")),
        "generation": e.where("event_type <> 'view'").select(ts, F.lit("fr").alias("zone_id"), F.col("event_type").alias("member"), F.col("value").alias("mw"), (n % 4 + 1).cast("int").alias("quality_rank")),
        "weather": e.where("event_type = 'error'").select(ts, F.when(n % 2 == 0, "fr").otherwise("de").alias("zone_id"), (F.col("value") / 10).alias("temperature_c")),
    }
    for name, rows in made.items():
        sinks.overwrite_partitions(sinks.with_partitions(rows), f"{root}/silver/{name}")
    jobs.build_marts(spark, {name: f"{root}/silver/{name}" for name in made}, f"{root}/gold", MONTH, GOLD, holidays=["2024-01-01"])
    return f"{root}/gold"


@query(f"""SELECT ts_hour, zone_id, n_points, ts_local, quality_rank, quality, {", ".join(f"round({c}, 8) AS {c}" for c in _GOLD_NUMBERS)}, DATE '2024-01-01' AS window_start, DATE '2024-01-31' AS window_end
    FROM ({_GOLD_MIX}) WHERE ts_hour >= TIMESTAMP '2024-01-01' AND ts_hour < TIMESTAMP '2024-02-01'""")
def gold_mix_job(spark, d):
    return rounded(spark.read.parquet(f"{_gold(spark, d)}/mix_hourly").drop("year", "month", "co2_g_kwh"), *_GOLD_NUMBERS)


@query(f"""SELECT ts_local::DATE AS date_local, zone_id, round(sum(load_mw) / 1000, 8) AS energy_gwh, round(avg(load_mw), 8) AS load_mean_mw, round(max(load_mw), 8) AS peak_mw,
    hour(arg_max(ts_local, (load_mw, -epoch(ts_hour))))::INTEGER AS peak_hour_local, CASE WHEN sum(production_mw) > 0 THEN round(100 * sum(clean_mw) / sum(production_mw), 8) END AS clean_pct,
    round(avg(temperature_c), 8) AS temperature_mean_c, round(min(temperature_c), 8) AS temperature_least_c, round(max(temperature_c), 8) AS temperature_most_c,
    round(avg(abs(forecast_error_mw)), 8) AS forecast_mae_mw, count(*) AS n_hours, count(load_mw) AS n_load, max(quality_rank) AS quality_rank,
    CASE WHEN avg(temperature_c) IS NOT NULL THEN round(greatest(18.0 - avg(temperature_c), 0), 8) END AS hdd, CASE WHEN avg(temperature_c) IS NOT NULL THEN round(greatest(avg(temperature_c) - 18.0, 0), 8) END AS cdd
    FROM ({_GOLD_MIX}) WHERE ts_local >= TIMESTAMP '2024-01-01' AND ts_local < TIMESTAMP '2024-02-01' GROUP BY 1, 2""")
def gold_kpi_job(spark, d):
    days = spark.read.parquet(f"{_gold(spark, d)}/kpi_daily").drop("year", "month", "window_start", "window_end", "co2_mean_g_kwh", "exchange_mean_mw")
    return rounded(days, "energy_gwh", "load_mean_mw", "peak_mw", "clean_pct", "temperature_mean_c", "temperature_least_c", "temperature_most_c", "forecast_mae_mw", "hdd", "cdd")


@query("""WITH z AS (SELECT date_trunc('hour', ts) AS ts_utc, CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS zone_id, avg(CASE WHEN event_id % 5 <> 0 THEN value END) AS t FROM events GROUP BY ALL)
    SELECT ts_utc, zone_id, round(t, 8) AS t, 2 AS quality_rank FROM z
    UNION ALL SELECT ts_utc, 'fr', round(sum(t * w) / nullif(sum(CASE WHEN t IS NOT NULL THEN w END), 0), 8), 1 FROM (SELECT *, CASE zone_id WHEN 'a' THEN 0.35::DOUBLE WHEN 'b' THEN 0.2 ELSE 0.0 END AS w FROM z) GROUP BY ts_utc""")
def weather_with_overall(spark, d):
    zone = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("event_id") % 3 + 1).cast("int"))
    rows = table(spark, d, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts_utc"), zone.alias("zone_id")).agg(F.avg(F.when(F.col("event_id") % 5 != 0, F.col("value"))).alias("t"))
    out = jobs.with_overall(rows.withColumn("quality_rank", F.lit(2)), {"a": 0.35, "b": 0.2}, ["t"], "fr", "consolidated", 1)
    return rounded(out.withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz")), "t")
