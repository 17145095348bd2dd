"""Behaviour of contracts, windows, validation, deduplication, readers and sinks on made-up feeds."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.temporal import local_time, to_instant
from lakeloom.operators import dedupe, reshape, validate, windows
from lakeloom.operators.forecast import train
from lakeloom.plans.contract import Dimension, Feed, Measure, Member, TableRules, first_known, load, plain_name
from lakeloom.plans.spans import Days, Reach, days_to_read, scheduled_days
from lakeloom.sources import readers, sinks


def test_names():
    assert plain_name("  Éolien (MW) ") == "eolien_mw"
    assert first_known(["b", "A é"], ["a_e", "B"]) == "B"
    assert first_known(["x"], ["y"]) is None


def test_contract_loads_nested_mappings():
    c = load({"tables": {"t": {"keys": ["k"], "measures": [{"target": "m", "low": 0}]}}, "sources": {"s": {"path": "p", "format": "csv"}}, "members": [{"name": "a", "level": "x"}, {"name": "b"}]})
    assert c.tables["t"].measures[0].low == 0 and c.sources["s"].format == "csv"
    assert [m.name for m in c.selected(["primary"])] == ["b"]
    with pytest.raises(ValueError):
        load({"members": [{"name": "a"}, {"name": "a"}]})


def test_window_algebra():
    w = Days.between("2023-12-20", "2024-02-05")
    assert list(w.months()) == [(2023, 12), (2024, 1), (2024, 2)]
    assert w.stop == date(2024, 2, 6) and w.days == 48
    assert w.whole_months() == Days.between("2023-12-01", "2024-02-29")
    span = Reach()
    assert (span.lookback, span.lookahead) == (8, 1)
    assert days_to_read(w, span) == Days.between("2023-11-23", "2024-03-01")
    assert scheduled_days({}, datetime(2024, 3, 1), datetime(2024, 4, 1)) == Days.between("2024-03-01", "2024-03-31")
    assert scheduled_days({"month": "2024-01", "month_end": "2024-02"}, datetime(2024, 3, 1), datetime(2024, 3, 2)).end == date(2024, 2, 29)
    with pytest.raises(ValueError):
        Days.between("2024-02-01", "2024-01-01")


def test_instants_with_and_without_offset(spark):
    df = spark.createDataFrame([("2024-03-15T00:00:00+01:00",), ("2024-03-15 00:00:00",), ("2024-03-14T23:00:00Z",), ("nope",), (None,)], "t string")
    got = [r[0] for r in df.select(to_instant(F.col("t"), "Europe/Paris").cast("string")).collect()]
    assert got == ["2024-03-14 23:00:00"] * 3 + [None, None]


def test_repeated_hour_keeps_its_instants(spark):
    texts = [f"2024-10-27T02:{m:02d}:00+0{o}:00" for o in (2, 1) for m in (0, 15, 30, 45)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_instant(F.col("t")).alias("ts"))
    assert df.distinct().count() == 8
    assert df.select(local_time(F.col("ts"), "Europe/Paris")).distinct().count() == 4


SPEC = TableRules(
    "t", keys=("ts_utc", "zone_id"), not_null=("ts_utc",), drop_if_all_null=("load",),
    measures=(Measure("load", ("Consommation",), low=10, high=100), Measure("wind", factor=1 / 3.6, low=0, high=50, policy="null_out"), Measure("absent")),
    dimensions=(Dimension("perimeter", ("périmètre",), ("France",)),),
)


def _feed(spark):
    rows = [
        ("2024-01-01 00:00:00", "fr", "50", "36", "France"),
        (None, "fr", "50", "36", "France"),
        ("2024-01-01 01:00:00", "fr", "ABC", "36", "France"),
        ("2024-01-01 02:00:00", "fr", "50", "36", "Mars"),
        ("2024-01-01 03:00:00", "fr", "500", "36", "France"),
        ("2024-01-01 04:00:00", "fr", "50", "3600", "France"),
        ("2024-01-01 05:00:00", "fr", " ", "36", None),
    ]
    return spark.createDataFrame(rows, "ts_utc string, zone_id string, consommation string, wind string, perimetre string")


def test_validation(spark, tmp_path):
    flagged = validate.flagged(_feed(spark), SPEC)
    reasons = {r["reason"]: r["column"] for r in flagged.select(validate.REASON + ".*").where("reason is not null").collect()}
    assert reasons == {"null_key": "ts_utc", "cast_failed": "load", "unexpected_value": "perimeter", "out_of_range": "load"}
    kept = validate.valid(flagged, SPEC).collect()
    assert [(r["load"], r["wind"], r["absent"]) for r in kept] == [(50.0, 10.0, None), (50.0, None, None)]
    report = validate.report(flagged, SPEC)
    assert (report.n_input, report.n_rejected, report.n_empty) == (7, 4, 1)
    with pytest.raises(validate.ValidationError):
        report.guard(0.25)
    report.save(str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["n_rejected"] == 4
    rejects = validate.quarantine(flagged, SPEC, ["zone_id", "consommation"]).collect()
    assert {json.loads(r["payload"])["consommation"] for r in rejects} == {"50", "ABC", "500"}
    with pytest.raises(validate.ValidationError):
        validate.check_required(_feed(spark), Feed("s", "p", "csv", required=("nothing",)))
    with pytest.raises(validate.ValidationError):
        validate.check_constant(_feed(spark), "zone_id", "de")


def test_dedupe_row_and_measure(spark):
    rows = [(1, "a", 1, 50200.0, None, 5), (1, "b", 2, 99999.0, 42.0, 9), (2, "a", 2, 1.0, 2.0, 1), (2, "b", 2, 3.0, None, 2)]
    df = spark.createDataFrame(rows, "k int, source string, quality_rank int, m double, n double, ingested_at int")
    order = dedupe.priority_order()
    assert sorted((r["k"], r["m"], r["n"]) for r in dedupe.by_priority(df, ["k"], order).collect()) == [(1, 50200.0, None), (2, 3.0, None)]
    assert sorted((r["k"], r["m"], r["n"]) for r in dedupe.by_merge(df, ["k"], order, ["m", "n"]).collect()) == [(1, 50200.0, 42.0), (2, 3.0, 2.0)]


def test_reshape(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, None, "7")], "id int, a string, b string")
    members = [Member("a", category="c"), Member("b", level="detail", parent="a"), Member("gone")]
    rows = reshape.unpivot(df, ["id"], members, "member", "v").collect()
    assert sorted((r["id"], r["member"], r["v"], r["_raw_v"]) for r in rows if r["v"] is not None) == [(1, "a", 5.0, "5"), (2, "b", 7.0, "7")]
    assert [r["_raw_v"] for r in rows if r["v"] is None] == ["x"]  # what fails to parse is kept for validation
    with pytest.raises(ValueError):
        reshape.unpivot(df, ["id"], [Member("gone")], "member", "v")


def test_offsets_are_of_exact_instants(spark):
    rows = [(datetime(2024, 1, 1, h), float(h)) for h in (0, 1, 3)]
    df = spark.createDataFrame(rows, "ts timestamp, v double").withColumn("z", F.lit("a"))
    out = windows.offsets(df, ["z"], "ts", {"lag": ("v", -1), "lead": ("v", 2)})
    assert [(r["lag"], r["lead"]) for r in out.orderBy("ts").collect()] == [(None, None), (0.0, 3.0), (None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= 1


def test_readers_and_gates(spark, tmp_path):
    folder = tmp_path / "feed" / "year=2024"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("A;Date\n1;2024-03-15 00:00:00\n")
    source = Feed("feed", "feed", "csv", required=("a",))
    got = readers.read_source(spark, str(tmp_path), source)
    assert dict(got.dtypes)["Date"] == "string" and got.count() == 1
    assert readers.read_source(spark, str(tmp_path), Feed("none", "none", "csv")) is None
    with pytest.raises(validate.ValidationError):
        readers.read_source(spark, str(tmp_path), Feed("feed", "feed", "tsv"))
    assert readers.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    with pytest.raises(validate.ValidationError):
        readers.gate_csv(b"x")
    with pytest.raises(validate.ValidationError):
        readers.gate_arrays({"hourly": {"a": [1, 2], "b": [1]}})
    readers.gate_xml(b"<d xmlns='u'><Point/><Point/></d>", least=2)
    answers = iter([(429, b""), (200, b"ok")])
    waits = []
    assert readers.pull(lambda: next(answers), sleep=waits.append) == b"ok" and waits == [4.0]
    seen = readers.Seen(2)
    pages = {0: [{"k": "a"}, {"k": "b"}], 2: [{"k": "b"}]}
    assert [r["k"] for r in readers.poll(lambda at, n: pages[at], lambda r: True, lambda r: r["k"], seen, 2)] == ["a", "b"]


def test_raw_files_and_quarantine_replay(spark, tmp_path):
    place = sinks.RawFolder(spark, str(tmp_path / "m"))
    assert not place.complete()
    place.put("x.csv", b"0")
    place.put("x.csv", b"1\xff")
    place.finish()
    assert place.complete() and (tmp_path / "m" / "x.csv").read_bytes() == b"1\xff" and not list((tmp_path / "m").glob("*.part"))
    w = Days.between("2024-01-01", "2024-01-31")
    bad = spark.createDataFrame([(1,)], "a int")
    assert sinks.write_quarantine(bad, str(tmp_path / "q"), w) == 1
    assert sinks.write_quarantine(bad.limit(0), str(tmp_path / "q"), w) == 0
    assert spark.read.parquet(str(tmp_path / "q")).count() == 0
    with pytest.raises(ValueError):
        sinks.overwrite_months(bad, str(tmp_path / "t"), Days.between("2024-01-02", "2024-01-31"))


def test_forecast(spark):
    rows = [(datetime(2024, 1, 1 + i // 24, i % 24), float(i % 24), float(i % 24) * 2 + 1, float(i % 24)) for i in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp, x double, y double, base double")
    out = train(df, "ts", ["x"], "y", ["base"], trees=5)
    assert out["results"]["ridge"]["mae"] < 0.5 < out["results"]["base"]["mae"]
    with pytest.raises(ValueError):
        train(df.limit(10), "ts", ["x"], "y", [])


def test_envelope_fields_come_from_all_payloads(spark, tmp_path):
    body = lambda i: json.dumps({"_meta": {}, "payload": {"k": str(i)} | ({"late.field": "x"} if i == 1500 else {})})
    rows = [json.dumps({"raw_value": body(i), "bronze_ingested_at": "t"}) for i in range(1501)]
    rows += [json.dumps({"raw_value": x, "bronze_ingested_at": "t"}) for x in ("{}", "no json")]
    (tmp_path / "lines.json").write_text("\n".join(rows))
    got = readers.read_envelope(spark, str(tmp_path), {})
    assert got.columns == ["k", "late.field", "bronze_ingested_at", "source_file"]
    assert [r["k"] for r in got.where("`late.field` is not null").collect()] == ["1500"] and got.count() == 1503


def test_polling_passes_pages_without_wanted_records():
    rows = [{"k": i, "v": None if i < 5 else 1} for i in range(12)]
    poll = lambda seen: [r["k"] for r in readers.poll(lambda at, n: rows[at : at + n], lambda r: r["v"], lambda r: r["k"], seen, 2)]
    seen = readers.Seen()
    assert poll(seen) == list(range(5, 12)) and poll(seen) == []


def test_months_are_pulled_once(spark, tmp_path):
    asked, window = [], Days.between("2023-12-05", "2024-01-10")

    def get(year, month):
        asked.append((year, month))
        return b"a\n" * (3000 if len(asked) != 2 else 1)

    folder = lambda y, m: sinks.RawFolder(spark, f"{tmp_path}/year={y}/month={m:02d}")
    with pytest.raises(validate.ValidationError):  # the second month's file is too short
        readers.pull_months(window, folder, get, "m.csv", readers.gate_csv)
    assert len(readers.pull_months(window, folder, get, "m.csv", readers.gate_csv)) == 1
    assert asked == [(2023, 12), (2024, 1), (2024, 1)] and readers.pull_months(window, folder, get, "m.csv") == []


def test_records_are_relayed_in_envelopes_and_days_are_optional():
    sent, seen = [], readers.Seen()
    page = lambda at, n: [{"k": "a", "v": 1}, {"k": "b", "v": None}][at : at + n]
    run = lambda: readers.relay(readers.poll(page, lambda r: r["v"] is not None, lambda r: r["k"], seen), lambda k, b: sent.append((k, json.loads(b))), lambda r: r["k"], {"source": "x"})
    assert (run(), run()) == (1, 0) and sent == [("a", {"_meta": {"source": "x"}, "payload": {"k": "a", "v": 1}})]

    def gone():
        raise OSError("no network")

    assert readers.optional_days(lambda: b'{"2024-05-01": "x", "2024-01-01": "y"}') == ["2024-01-01", "2024-05-01"]
    assert readers.optional_days(gone) == readers.optional_days(lambda: b"<html>") == []


FEEDS = {
    "qualities": {"good": 1, "poor": 2}, "instants": ["date"], "zone": "Europe/Paris", "quality_columns": ["nature"], "quality_texts": {"fait": "good"}, "max_reject_ratio": 0.5,
    "sources": {"a": {"path": "a", "format": "csv", "default_quality": "poor"}, "b": {"path": "b", "format": "csv"}},
    "tables": {"t": {"keys": ["ts_utc"], "not_null": ["ts_utc"], "lineage": ["source", "ts_utc", "quality", "quality_rank", "ingested_at", "nowhere"], "measures": [{"target": "load", "low": 0}]}},
}


def test_load_job_quarantines_guards_and_replaces(spark, tmp_path):
    from lakeloom.plans import jobs

    contract, month = load(FEEDS), Days.between("2024-01-01", "2024-01-31")
    (tmp_path / "a").mkdir()
    lines = ["Date;load;nature", "2024-01-05 00:00:00;1;Fait", "2024-01-05 00:00:00;2;", "2024-01-06T00:00:00Z;-5;", "never;7;", "2024-02-05 00:00:00;9;"]
    (tmp_path / "a" / "x.csv").write_text("\n".join(lines))
    done = jobs.load_table(spark, contract, "t", str(tmp_path), str(tmp_path / "out"), month, "fr")
    assert (done.n_written, done.n_quarantined) == (1, 2)
    assert [(r.feed, r.n_input, r.n_rejected, r.n_unparsed, r.reasons) for r in done.reports] == [("a", 4, 2, 1, {"null_key:ts_utc": 1, "out_of_range:load": 1})]
    rows = spark.read.parquet(str(tmp_path / "out" / "t"))
    assert rows.columns == ["source", "ts_utc", "quality", "quality_rank", "ingested_at", "load", "year", "month"]
    r = rows.first()
    assert (r["ts_utc"].isoformat(), r["quality"], r["quality_rank"], r["load"]) == ("2024-01-04T23:00:00", "good", 1, 1.0) and r["ingested_at"]
    done.save(str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["feeds"][0]["ratio"] == 0.5
    # One more reject is more than the contract allows: the table stays, the rejects are there.
    (tmp_path / "a" / "y.csv").write_text("Date;load;nature\n2024-01-07 00:00:00;x;\n2024-01-05 00:00:00;5;Fait")
    (tmp_path / "a" / "z.csv").write_text("Date;load;nature\n2024-01-08 00:00:00;x;")
    with pytest.raises(validate.ValidationError):
        jobs.load_table(spark, contract, "t", str(tmp_path), str(tmp_path / "out"), month, "fr")
    assert spark.read.parquet(str(tmp_path / "out" / "t")).count() == 1 and spark.read.parquet(str(tmp_path / "out" / "quarantine" / "t")).count() == 4
    with pytest.raises(validate.ValidationError):
        jobs.load_table(spark, contract, "t", str(tmp_path / "empty"), str(tmp_path / "out"), month)
    with pytest.raises(ValueError):
        jobs.load_table(spark, contract, "t", str(tmp_path), str(tmp_path / "out"), Days.between("2024-01-02", "2024-01-31"))


def test_raw_times_win_over_now(spark):
    from lakeloom.plans import jobs

    contract = load(FEEDS)
    df = spark.createDataFrame([("2024-07-01 12:00", "2024-07-02 00:00:00", "f"), ("bad", None, None)], "date string, bronze_ingested_at string, source_file string")
    rows = jobs.traced(df, contract, contract.sources["b"]).withColumn("bad", jobs.unparsed(contract, df.columns)).collect()
    assert [(r["ingested_at"].isoformat()[:10] == "2024-07-02", r["source_file"], r["quality"], r["quality_rank"], r["bad"]) for r in rows] == [(True, "f", None, 99, False), (False, None, None, 99, True)]
    assert rows[0]["ts_local"].hour == 12 and rows[0]["ts_utc"].hour == 10
    with pytest.raises(validate.ValidationError):
        jobs.traced(df.drop("date"), contract, contract.sources["b"])


def test_exact_instants_of_a_share(spark):
    import random

    from lakeloom.operators import forecast

    rng = random.Random(1)
    times = [datetime(2024, 1, 1 + rng.randrange(3), rng.randrange(24), 0, rng.randrange(2), rng.randrange(3)) for _ in range(400)] + [datetime(1969, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(t,) for t in times] + [(None,)] * 50, "ts timestamp_ntz")
    for share in (0.0, 0.1, 0.5, 0.8, 1.0):
        want = sorted(times)[max(1, -int(-share * len(times) // 1)) - 1]
        at = forecast.instant_at(df, "ts", share)
        assert datetime(1970, 1, 1).timestamp() + at / 1e6 == pytest.approx(want.timestamp(), abs=1e-6)
        before, after = forecast.split(df, "ts", share)
        assert (before.count(), after.count()) == (sum(t < want for t in times), sum(t >= want for t in times))
    assert forecast.instant_at(df.limit(0), "ts", 0.5) is None and forecast.split(df.limit(0), "ts")[0].count() == 0


def test_rolling_rows_in_blocks_equal_the_window(spark):
    import random

    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), datetime(2024, 1, 1 + rng.randrange(28), rng.choice([0, 0, 12, 23]), 0, 0, rng.choice([0, 0, 1])), None if i % 9 == 0 else float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, k string, ts timestamp, v double")
    want = {r["i"]: r["m"] for r in df.withColumn("m", windows.rolling_open("v", ["k"], "ts", 24)).collect()}
    got = windows.rolling_open_rows(df, "v", ["k"], "ts", 24, "m", span=2).collect()
    assert len(got) == 500 and all(r["m"] == pytest.approx(want[r["i"]]) for r in got)


def test_rolling_rows_add_each_row_once_and_take_none_off(spark):
    import random
    import re

    rng = random.Random(3)
    odd = [float("inf"), float("nan"), 1e300, None, 0.1]
    times = [None, datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), datetime(1970, 1, 2), datetime(1970, 1, 1, 23, 59, 59, 999999)]
    rows = [(i, rng.choice(["a", None]), rng.choice(times) or rng.choice([None, datetime(1969, 12, 25 + rng.randrange(7), rng.randrange(24))]), rng.choice(odd) if i % 50 == 0 else rng.random()) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, k string, ts timestamp, v double")
    want = {r["i"]: r["m"] for r in df.withColumn("m", windows.rolling_open("v", ["k"], "ts", 24)).collect()}
    for span in (1, 2, 24):
        out = windows.rolling_open_rows(df, "v", ["k"], "ts", 24, "m", span=span)
        # A frame with a moving start is added up anew for each row: time by the square of a crowd.
        frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+),", out._jdf.queryExecution().executedPlan().toString())
        assert frames and set(frames) == {"unboundedpreceding$()"}
        got = {r["i"]: r["m"] for r in out.collect()}
        assert out.columns == [*df.columns, "m"] and len(got) == 1500
        assert all(m is None if want[i] is None else m == pytest.approx(want[i], nan_ok=True) for i, m in got.items())


def test_small_functions_no_query_shows(spark, tmp_path):
    from lakeloom.functions.temporal import within
    from lakeloom.operators import aggregate, forecast
    from lakeloom.streaming import bronze

    assert readers.describe_schema(spark.createDataFrame([], "date_heure string, code_insee string, load double")) == [("date_heure", "string", "time"), ("code_insee", "string", "dimension"), ("load", "double", "measure")]
    units = spark.createDataFrame([(("km/h",),), (("m/s",),)], "units struct<wind: string>")
    spec = TableRules("w", keys=(), measures=(Measure("wind", source_unit="km/h"), Measure("gone", source_unit="x")))
    assert validate.unit_notes(units, "units", spec) == ["wind: m/s announced, km/h declared"]
    forecast.save({"a": 1.5}, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": 1.5}
    df = spark.createDataFrame([("2024-01-01 00:10", 1, 4.0), ("2024-01-01 00:20", 3, None), (None, 2, 1.0)], "t string, q int, v double").withColumn("ts", F.col("t").cast("timestamp"))
    hour = aggregate.hourly(df, "ts", [], ["v"], rank="q").where("ts_hour is not null").first()
    assert (hour["v"], hour["n_points"], hour["q"]) == (4.0, 1, 3)
    days = Days.between("2024-01-01", "2024-01-01")
    assert (df.where(within(F.col("ts"), days)).count(), df.where(within(F.col("ts"), days, keep_null=True)).count()) == (2, 3)
    odd = TableRules("k", keys=(), measures=(Measure("v", low=0, high=2, policy="keep"),))
    flagged = validate.flagged(df, odd)
    assert validate.valid(flagged, odd).where("v > 2").count() == 1 and validate.rules_of(odd) == [("cast_failed", "v")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"key": "k", "value": "v", "topic": "t", "partition": 0, "offset": 1}\n' * 3)
    query = bronze.RawSink(str(tmp_path / "raw"), str(tmp_path / "check")).drain(bronze.raw_records(bronze.file_stream(spark, str(tmp_path / "in"))))
    query.awaitTermination()
    assert bronze.progress(query)["rows"] == 3 and bronze.progress(query)["batches"] == 1
    follow = bronze.RawSink(str(tmp_path / "raw2"), str(tmp_path / "check2")).follow(bronze.raw_records(bronze.file_stream(spark, str(tmp_path / "in"))), "1 second")
    follow.processAllAvailable()
    follow.stop()
    assert spark.read.json(str(tmp_path / "raw2")).count() == 3


def test_globs_and_reports(spark, tmp_path):
    for name in ("a.csv", "b.txt"):
        (tmp_path / name).write_text("x;y\n1;2\n")
    assert readers.read_source(spark, str(tmp_path), Feed("f", "", "csv", glob="*.csv")).count() == 1
    tally = validate.Tally(SPEC, "feed")
    rows = tally.watch(validate.flagged(_feed(spark), SPEC))
    assert rows.count() == 7
    plain, told = validate.report(validate.flagged(_feed(spark), SPEC), SPEC), tally.report()
    assert (told.n_input, told.n_rejected, told.n_empty, told.reasons) == (plain.n_input, plain.n_rejected, plain.n_empty, plain.reasons)
