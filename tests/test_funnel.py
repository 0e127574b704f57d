"""Daily funnel against a row-by-row computation."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import DateWindow
from tidewatch.operators.stages import COUNT, DISTINCT, SUM, Lookup, Stage
from tidewatch.plans.funnel import (
    REVENUE_FUNNEL_LOOKUP,
    REVENUE_FUNNEL_STAGES,
    FunnelSource,
)
from tidewatch.sources import REVENUE_FUNNEL_ROLES, ChannelMap

WINDOW = DateWindow(dt.date(2024, 1, 2), dt.date(2024, 1, 5))
CHANNELS = ChannelMap({"a": "O&O", "b": "O&O", "c": "SEM", "d": "SEO"})
MEASURES = ("intentful_visitors", "requests", "projects", "contacts", "revenue")


def random_data(seed, rows=300, hot=0.35):
    """Roles with repeats, NULLs, unmapped segments, orphans and one hot request."""
    rng = random.Random(seed)

    def moment():
        if rng.random() < 0.05:
            return None
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(6 * 24 * 60))

    def segment():
        return rng.choice(["a", "b", "c", "d", "unmapped", None])

    def key():
        if rng.random() < hot:
            return 1
        return rng.choice([None, *range(1, 40)])

    def amount(chance=0.8):
        return Decimal(rng.randrange(-5000, 20000)).scaleb(-4) if rng.random() < chance else None

    def day():
        t = moment()
        return t.date() if t else None

    return {
        "visits": [(day(), segment()) for _ in range(rows)],
        "requests": [(rng.choice([None, *range(1, 30)]), moment(), segment()) for _ in range(60)],
        "projects": [(key(), moment()) for _ in range(rows)],
        "contacts": [(rng.choice([None, *range(80)]), key(), moment()) for _ in range(rows)],
        "rev_a": [(key(), moment(), amount()) for _ in range(rows)],
        "rev_b": [
            (key(), moment(), amount(), amount(0.3), amount(0.3), amount(0.3), amount(0.3))
            for _ in range(rows)
        ],
    }


def pacific(moment):
    return None if moment is None else (moment - dt.timedelta(hours=8)).date()


def brute_force(data, level, window):
    """The funnel as nested loops over the rows."""

    def dimension(segment):
        return "overall" if level == "overall" else CHANNELS.channel_of.get(segment, "Other")

    def matches(key):
        found = [r for r in data["requests"] if key is not None and r[0] == key]
        return [r[2] for r in found] or [None]

    def inside(day):
        return day is not None and window.start <= day <= window.end

    visits, entities, revenue = defaultdict(int), defaultdict(set), defaultdict(list)
    seen = set()
    for day, segment in data["visits"]:
        if inside(day):
            visits[day, dimension(segment)] += 1
            seen.add((day, dimension(segment)))
    for pk, moment, segment in data["requests"]:
        if inside(pacific(moment)):
            entities["requests", pacific(moment), dimension(segment)].add(pk)
    for pk, moment in data["projects"]:
        if inside(pacific(moment)):
            for segment in matches(pk):
                entities["projects", pacific(moment), dimension(segment)].add(pk)
    for contact, pk, moment in data["contacts"]:
        if inside(pacific(moment)):
            for segment in matches(pk):
                entities["contacts", pacific(moment), dimension(segment)].add(contact)
    amounts = [(pk, moment, x) for pk, moment, x in data["rev_a"]]
    for pk, moment, net, *rest in data["rev_b"]:
        total = None if net is None else net + sum((x for x in rest if x is not None), Decimal(0))
        amounts.append((pk, moment, total))
    for pk, moment, x in amounts:
        if inside(pacific(moment)):
            for segment in matches(pk):
                revenue[pacific(moment), dimension(segment)].append(x)
    seen |= {(day, dim) for _, day, dim in entities} | set(revenue)
    rows = set()
    for day, dim in seen:
        counts = [len(entities[m, day, dim] - {None}) for m in ("requests", "projects", "contacts")]
        paid = sum((x for x in revenue[day, dim] if x is not None), Decimal(0))
        rows.add((day, dim, visits[day, dim], *counts, paid))
    return rows


def source_of(spark, data, lookup=REVENUE_FUNNEL_LOOKUP):
    roles = {
        name: spark.createDataFrame(rows, REVENUE_FUNNEL_ROLES[name]) for name, rows in data.items()
    }
    return FunnelSource(roles, REVENUE_FUNNEL_STAGES, lookup, CHANNELS)


def rows_of(df):
    return {tuple(r) for r in df.select("metric_date", "dimension", *MEASURES).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_against_loops(spark, seed):
    data = random_data(seed)
    daily = source_of(spark, data).daily(["overall", "channel"], WINDOW)
    for level in ("overall", "channel"):
        got = daily.filter(F.col("dim_type") == level)
        assert got.count() == len(rows_of(got))
        assert rows_of(got) == brute_force(data, level, WINDOW)


def test_single_level_pulls_and_outer_join_form(spark):
    data = random_data(3)
    source = source_of(spark, data)
    for level in ("overall", "channel"):
        expected = brute_force(data, level, WINDOW)
        assert rows_of(source.daily([level], WINDOW)) == expected
        assert rows_of(source.daily_by_outer_join(level, WINDOW)) == expected


def test_chosen_days_are_the_days_of_the_full_pull(spark):
    data = random_data(4)
    days = WINDOW.only(dt.date(2024, 1, 3), dt.date(2024, 1, 5), dt.date(2024, 2, 1))
    got = rows_of(source_of(spark, data).daily(["channel"], days))
    assert got == {r for r in brute_force(data, "channel", WINDOW) if r[0] in days.days}


def test_unique_lookup_gives_the_same_when_keys_are_unique(spark):
    data = random_data(5)
    data["requests"] = list({r[0]: r for r in data["requests"]}.values())
    unique = Lookup("requests", "request_pk", "segment", unique=True)
    for levels in (["overall", "channel"], ["overall"]):
        fast = source_of(spark, data, unique).daily(levels, WINDOW)
        safe = source_of(spark, data).daily(levels, WINDOW)
        assert rows_of(fast) == rows_of(safe)
    # With unique keys nothing is counted twice, so channels add up to the whole.
    daily = source_of(spark, data, unique).daily(["overall", "channel"], WINDOW)
    totals = {
        (r.dim_type, r.metric_date): r.revenue
        for r in daily.groupBy("dim_type", "metric_date").agg(F.sum("revenue").alias("revenue")).collect()
    }
    for (level, day), revenue in totals.items():
        assert revenue == totals["overall", day], level


def test_timestamps_with_zone_and_string_keys(spark, session_zone):
    session_zone("Asia/Tokyo")
    data = random_data(6)
    roles = {}
    for name, rows in data.items():
        df = spark.createDataFrame(rows, REVENUE_FUNNEL_ROLES[name])
        for field in df.schema:
            if field.dataType.simpleString() == "timestamp_ntz":
                epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
                micros = F.timestamp_diff("MICROSECOND", epoch, field.name)
                df = df.withColumn(field.name, F.timestamp_micros(micros))
            if field.name.endswith("_pk"):
                df = df.withColumn(field.name, F.concat(F.lit("k"), F.col(field.name)))
        roles[name] = df
    source = FunnelSource(roles, channels=CHANNELS)
    got = source.daily(["channel"], WINDOW)
    assert rows_of(got) == brute_force(data, "channel", WINDOW)


def test_nan_amounts_and_empty_stages(spark):
    roles = {
        "views": spark.createDataFrame([(dt.date(2024, 1, 3), "a")], "day date, segment string"),
        "sales": spark.createDataFrame(
            [(dt.date(2024, 1, 3), "a", float("nan")), (dt.date(2024, 1, 3), "a", 2.5)],
            "day date, segment string, amount double",
        ),
        "none": spark.createDataFrame([], "day date, id string, segment string"),
    }
    stages = [
        Stage("views", COUNT, "views", "day", segment="segment"),
        Stage("sales", SUM, "sales", "day", "amount", segment="segment"),
        Stage("things", DISTINCT, "none", "day", "id", segment="segment"),
    ]
    source = FunnelSource(roles, stages, None, CHANNELS, sum_type="double")
    rows = source.daily(["channel"], WINDOW).collect()
    assert [(r.dimension, r.views, r.sales, r.things) for r in rows] == [("O&O", 1, 2.5, 0)]
    assert source.has_rows_on(dt.date(2024, 1, 3))
    assert not source.has_rows_on(dt.date(2024, 1, 4))
    assert source.latest_day(WINDOW) == dt.date(2024, 1, 3)
    assert source.latest_day(DateWindow(dt.date(2025, 1, 1), dt.date(2025, 1, 2))) is None


def test_unknown_levels_and_bad_stages_are_errors(spark):
    source = source_of(spark, random_data(7, rows=3))
    with pytest.raises(ValueError, match="unknown dimension level"):
        source.daily(["overall", "region"], WINDOW)
    with pytest.raises(ValueError, match="no data given"):
        FunnelSource({"visits": source.roles["visits"]})
    with pytest.raises(ValueError, match="kind"):
        Stage("x", "median", "visits", "visit_date", segment="segment")
    with pytest.raises(ValueError, match="needs a value"):
        Stage("x", SUM, "visits", "visit_date", segment="segment")
    with pytest.raises(ValueError, match="lookup key"):
        Stage("x", COUNT, "visits", "visit_date")


def test_many_channels(spark):
    many = ChannelMap({f"s{i}": f"c{i}" for i in range(61)})
    day = dt.date(2024, 1, 3)
    rows = [(day, 1, f"s{i}") for i in range(61)] + [(day, 2, "nowhere")]
    roles = {"things": spark.createDataFrame(rows, "day date, id int, segment string")}
    stage = Stage("things", DISTINCT, "things", "day", "id", segment="segment")
    daily = FunnelSource(roles, [stage], None, many).daily(["overall", "channel"], WINDOW)
    got = {r.dimension: r.things for r in daily.collect()}
    assert got == {"overall": 2, "Other": 1} | {f"c{i}": 1 for i in range(61)}


def test_sums_keep_the_scale_of_their_input(spark):
    day = dt.date(2024, 1, 3)
    rows = [(day, "0.000049", "a"), (day, "0.000001", "b")]
    things = spark.createDataFrame(rows, "day date, amount string, segment string")
    roles = {"things": things.withColumn("amount", F.col("amount").cast("decimal(18,6)"))}
    stage = Stage("total", SUM, "things", "day", "amount", segment="segment")
    daily = FunnelSource(roles, [stage], None).daily(["overall"], WINDOW)
    assert str(daily.first()["total"]) == "0.000050"
    fixed = FunnelSource(roles, [stage], None, sum_type="decimal(18,4)").daily(["overall"], WINDOW)
    assert str(fixed.first()["total"]) == "0.0001"


def test_any_number_of_levels_and_open_windows(spark):
    days = [dt.date(1700, 1, 1), dt.date(2024, 1, 3), dt.date(2090, 1, 1)]
    rows = [(day, i, f"s{i % 200}", i % 3 or None) for i, day in enumerate(days * 300)]
    roles = {"things": spark.createDataFrame(rows, "day date, id int, segment string, size int")}
    stage = Stage("things", DISTINCT, "things", "day", "id", segment="segment", levels={"size": "size"})
    channels = ChannelMap({f"s{i}": f"c{i}" for i in range(150)})
    daily = FunnelSource(roles, [stage], None, channels).daily(
        ["overall", "channel", "size"], DateWindow.always()
    )
    got = {(r.metric_date, r.dim_type, r.dimension): r.things for r in daily.collect()}
    want = {}
    for day, i, segment, size in rows:
        channel = channels.channel_of.get(segment, "Other")
        for key in (("overall", "overall"), ("channel", channel), ("size", str(size or "Other"))):
            want.setdefault((day, *key), set()).add(i)
    assert got == {key: len(ids) for key, ids in want.items()}


def test_stages_can_filter_one_event_table(spark):
    day = dt.date(2024, 1, 3)
    events = spark.createDataFrame(
        [(day, "view", "a"), (day, "view", None), (day, "error", "a")],
        "day date, kind string, segment string",
    )
    stages = [
        Stage(kind, COUNT, "events", "day", segment="segment", where=f"kind = '{kind}'")
        for kind in ("view", "error")
    ]
    daily = FunnelSource({"events": events}, stages, None, CHANNELS).daily(["channel"], WINDOW)
    got = {r.dimension: (r["view"], r["error"]) for r in daily.collect()}
    assert got == {"O&O": (1, 1), "Other": (1, 0)}


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("facts_key", ["bigint", "string"])
def test_levels_of_repeated_keys_against_sets(spark, unique, facts_key):
    """Keys with several values at each level, repeated facts, NULL entities, further own levels."""
    day = dt.date(2024, 1, 3)
    known = [(k % 7, f"s{k % 5}", f"z{k % 3 or None}") for k in range(40)] + [(None, "s1", "z1")]
    facts = [(day, k % 9 if k % 8 else None, k % 11 if k % 10 else None, f"o{k % 4}") for k in range(60)]
    facts += facts[:20]
    roles = {
        "known": spark.createDataFrame(known, "k bigint, segment string, zone string"),
        "facts": spark.createDataFrame(facts, "day date, k bigint, id bigint, own string").withColumn(
            "k", F.col("k").cast(facts_key)
        ),
    }
    channels = ChannelMap({f"s{i}": f"c{i % 3}" for i in range(4)})
    lookup = Lookup("known", "k", "segment", unique=unique, levels={"zone": "zone", "own": "zone"})
    stages = [
        Stage("keys", DISTINCT, "facts", "day", "k", lookup_key="k"),
        Stage("ids", DISTINCT, "facts", "day", "id", lookup_key="k"),
        Stage("owned", DISTINCT, "facts", "day", "k", lookup_key="k", levels={"own": "own"}),
    ]
    names = {"keys": 1, "ids": 2, "owned": 1}
    for levels in (["overall"], ["zone"], ["zone", "channel"], ["overall", "channel", "zone"], ["own", "overall"]):
        want = {}
        for row in facts:
            matches = [m for m in known if row[1] is not None and m[0] == row[1]] or [(None, None, None)]
            for _, segment, zone in matches:
                value = {"overall": "overall", "channel": channels.channel_of.get(segment, "Other"), "zone": zone or "Other"}
                for name, place in names.items():
                    own = row[3] if name == "owned" else zone or "Other"
                    for level in levels:
                        key = (level, (value | {"own": own})[level])
                        want.setdefault(key, {n: set() for n in names})[name].add(row[place])
        daily = FunnelSource(roles, stages, lookup, channels).daily(levels, WINDOW).collect()
        got = {(r.dim_type, r.dimension): {n: r[n] for n in names} for r in daily}
        assert len(daily) == len(got)
        assert got == {key: {n: len(ids - {None}) for n, ids in sets.items()} for key, sets in want.items()}
