"""URL filters by a temporal list join.

Dated list entries (add or remove a key at a time) become validity intervals: an addition holds until the next
entry of the same list and key. Every capture is decided against the entries that are active at its fetch time. Of the
active entries the one with the longest key decides; at equal length ``block`` wins over ``allow``.

Each key's intervals become a timeline by a sweep over their begins and ends: at every time at which one begins or ends,
the entry that decides from then on.
Captures meet the timelines by an as-of join: both are put together, sorted by time within a key, and each capture
takes the last entry of the timeline before it; no capture is ever paired with more than one entry of a key. Keys with
more than ``PER_TASK`` captures are dealt over several values of a salt, for each of which their timeline (small, it
holds entries only) is repeated, so that a host with a third of all captures meets no single task. Captures none of
whose host suffixes is listed are passed by a sieve of fixed size.

Edge cases: captures with a null or host-less url, or a null time, match nothing and are allowed; entries with a
null key, time or action are ignored; entries of one list and key at the same time count as one, a removal first;
an addition that repeats just starts a new interval; keys match in lower case, without a leading or trailing dot;
hosts that are IP addresses (version 6 in brackets) match as a whole only; urls of any length are read whole;
repeated captures give a row each; empty tables on either side give the captures as allowed, or no row; other columns
of the captures, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sieve

#: Captures of a key that one task sorts.
PER_TASK = 65_536
#: The host of an absolute URL, without user and port; an address in brackets is a host.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:@\[\]]+)"
ADDRESS = r"^(\[.*\]|[0-9.]+)$"


def host(url: Column) -> Column:
    """The host in lower case, null if there is none."""
    h = F.trim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(h != "", h)


def suffixes(h: Column) -> Column:
    """The host and its parent domains: a.b.c, b.c, c; of an address itself alone."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    return F.when(h.rlike(ADDRESS), F.array(h)).otherwise(F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """list, kind, key and [valid_from, valid_to) of every addition; valid_to is null while it holds."""
    key = F.trim(F.lower("key"), F.lit("."))
    usable = entries.filter("key IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')").select("list", "kind", key.alias("key"), "at", "action")
    once = usable.groupBy("list", "kind", "key", "at").agg(F.max("action").alias("action"))  # "remove" sorts after "add"
    w = Window.partitionBy("list", "kind", "key").orderBy("at")
    return once.withColumn("valid_to", F.lead("at").over(w)).filter("action = 'add'").select("list", "kind", "key", F.col("at").alias("valid_from"), "valid_to")


def timelines(entries: DataFrame) -> DataFrame:
    """key, at and entry: from ``at`` on, until the key's next row, ``entry`` decides (null: none is active). The begins
    and ends of a key's intervals are swept in order of time; a task keeps the entries that are active, one a list and
    kind, so a key with n entries costs n steps."""
    held, marks = intervals(entries), F.unix_micros(F.col("at").cast("timestamp"))
    of = lambda c, begins: held.filter(F.col(c).isNotNull()).select("key", F.col(c).alias("at"), F.lit(begins).alias("begins"), (F.col("kind") == "block").alias("block"), "list", F.col("valid_from").alias("since"))
    events = of("valid_from", 1).unionByName(of("valid_to", 0)).withColumn("at", marks).withColumn("since", F.unix_micros(F.col("since").cast("timestamp")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, active, order = None, None, {}, []  # order: the active (block, list), least first

        def row() -> tuple:
            return (key, now, *(((*order[-1], active[order[-1]])) if order else (None, None, None)))

        for b in batches:
            out = []
            for k, at, begins, block, name, since in zip(*(b.column(c).to_pylist() for c in ("key", "at", "begins", "block", "list", "since"))):
                if key is not None and (k, at) != (key, now):
                    out.append(row())
                if k != key:
                    active, order = {}, []
                key, now = k, at
                place = (block, name or "")
                if begins:
                    if place not in active:
                        insort(order, place)
                    active[place] = since
                elif active.get(place) == since:
                    del active[place]
                    del order[bisect_left(order, place)]
            if out:
                yield made(out)
        if key is not None:
            yield made([row()])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["key", "at", "block", "list", "since"])

    swept = events.repartition("key").sortWithinPartitions("key", "at", "begins").mapInArrow(run, "key string, at long, block boolean, list string, since long")
    entry = F.struct("block", "list", F.timestamp_micros("since").alias("valid_from"))
    return swept.select("key", F.timestamp_micros("at").alias("at"), F.when(F.col("since").isNotNull(), entry).alias("entry"))


def decide(captures: DataFrame, entries: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """page_id, host, fetched_at, verdict (block or allow), and the deciding list, key and valid_from, for captures
    (page_id, url, fetched_at) against entries (list, kind block or allow, key, action, at)."""
    rows = captures.select("page_id", host(F.col("url")).alias("host"), "fetched_at")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "url-captures")
    line = materialize(timelines(entries), "url-timelines")
    keyed = rows.filter("fetched_at IS NOT NULL AND host IS NOT NULL").select("row", "fetched_at", F.explode(suffixes(F.col("host"))).alias("key"))
    keyed = sieve(keyed, line.select("key").distinct()).filter("__hit").drop("__hit")
    salts = keyed.groupBy("key").agg(F.ceil(F.count("*") / per_task).cast("int").alias("salts"))
    left = keyed.join(salts, "key").select("key", F.pmod(F.xxhash64("row"), "salts").cast("int").alias("salt"), F.col("fetched_at").alias("at"), "row", F.lit(None).cast(line.schema["entry"].dataType).alias("entry"), F.lit(1).alias("turn"))
    right = line.join(salts, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "at", F.lit(None).cast("long").alias("row"), "entry", F.lit(0).alias("turn"))
    # a timeline row without an entry must end the one before it, so the last row is taken and not the last entry
    here = F.when(F.col("turn") == 0, F.struct("entry"))
    last = F.last(here, ignorenulls=True).over(Window.partitionBy("key", "salt").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0))
    asof = left.unionByName(right).withColumn("last", last).filter("turn = 1 AND last.entry IS NOT NULL").select("row", "key", F.col("last.entry").alias("entry"))
    size = F.length("key").alias("size")
    best = asof.groupBy("row").agg(F.max(F.struct(size, "entry.block", "entry.list", "key", "entry.valid_from")).alias("e"))
    best = materialize(best, "url-decided")
    found = rows.join(best, "row", "left")
    return found.select("page_id", "host", "fetched_at", F.when(F.col("e.block"), "block").otherwise("allow").alias("verdict"), F.col("e.list").alias("list"), F.col("e.key").alias("key"), F.col("e.valid_from").alias("valid_from"))


# The tables have neither fetch times nor lists, so the query derives both by rules that SQL can state as well:
# numbers come from the first six hex digits of an MD5.
START = "2024-01-01 00:00:00"
FIXED = (("spam", "block", "casino-win.example.com", "add", 60), ("ads", "block", "ads-track.example.com", "add", 30), ("ads", "block", "ads-track.example.com", "remove", 200), ("trusted", "allow", "example.org", "add", 0))


def _number(x: Column, below: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(x), 1, 6), 16, 10).cast("long"), F.lit(below))


def _day(n: Column | int) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + (n if isinstance(n, Column) else F.lit(n)) * 86_400)


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time within a year, to the hour."""
    return pages.select("page_id", "url", F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + _number(F.col("page_id").cast("string"), 366 * 24) * 3_600).alias("fetched_at"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages: a fifth of the hosts are added, removed 45 days later and half of
    them added again after 90 more; and a few fixed entries."""
    hosts = pages.select(host(F.col("url")).alias("key")).filter("key IS NOT NULL").distinct().filter(_number(F.concat(F.lit("list:"), "key"), 5) == 0)
    first = _number(F.concat(F.lit("day:"), "key"), 200)
    again = _number(F.concat(F.lit("again:"), "key"), 2) == 0
    steps = F.array(F.struct(F.lit("add").alias("action"), first.alias("day")), F.struct(F.lit("remove").alias("action"), (first + 45).alias("day")), F.struct(F.when(again, "add").otherwise("none").alias("action"), (first + 135).alias("day")))
    dated = hosts.select(F.lit("hosts").alias("list"), F.lit("block").alias("kind"), "key", F.inline(steps)).select("list", "kind", "key", "action", _day(F.col("day")).alias("at"))
    fixed = pages.sparkSession.createDataFrame(list(FIXED), "list string, kind string, key string, action string, day int")
    return dated.unionByName(fixed.select("list", "kind", "key", "action", _day(F.col("day")).alias("at")))


_N = "(('0x' || substr(md5({}), 1, 6))::BIGINT % {})"
SQL = f"""
WITH c AS (SELECT row_number() OVER () AS r, page_id, nullif(trim(lower(regexp_extract(url, '{HOST}', 1)), '.'), '') AS host,
    TIMESTAMP '{START}' + to_hours({_N.format("page_id::VARCHAR", 366 * 24)}) AS fetched_at FROM pages),
h AS (SELECT DISTINCT host AS key FROM c WHERE host IS NOT NULL AND {_N.format("'list:' || host", 5)} = 0),
f AS (SELECT key, {_N.format("'day:' || key", 200)} AS day, {_N.format("'again:' || key", 2)} = 0 AS again FROM h),
e AS (SELECT 'hosts' AS list, 'block' AS kind, key, 'add' AS action, day FROM f UNION ALL SELECT 'hosts', 'block', key, 'remove', day + 45 FROM f
    UNION ALL SELECT 'hosts', 'block', key, 'add', day + 135 FROM f WHERE again
    UNION ALL VALUES {", ".join(f"('{a}', '{b}', '{k}', '{x}', {d})" for a, b, k, x, d in FIXED)}),
i AS (SELECT *, TIMESTAMP '{START}' + to_days(day::INTEGER) AS valid_from, TIMESTAMP '{START}' + to_days((lead(day) OVER (PARTITION BY list, kind, key ORDER BY day))::INTEGER) AS valid_to FROM e),
m AS (SELECT r, list, key, kind, valid_from, row_number() OVER (PARTITION BY r ORDER BY length(key) DESC, kind DESC, list DESC, valid_from DESC) AS n
    FROM c JOIN i ON i.action = 'add' AND (host = key OR ends_with(host, '.' || key)) AND valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to))
SELECT page_id, host, fetched_at, CASE WHEN kind = 'block' THEN 'block' ELSE 'allow' END AS verdict, list, key, valid_from FROM c LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (r)
"""
