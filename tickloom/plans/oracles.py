"""The registered queries as SQL over the given tables, for an independent engine."""

from __future__ import annotations

OHLCV = '"Open", "High", "Low", "Close", "Total_Volume"'
ROUNDED = ", ".join(f'round({c}, 4) AS {c}' for c in OHLCV.split(", "))

PLAIN = """
    SELECT event_type AS "Symbol", value AS "Price",
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "Volume", ts AS "Trade_Time",
           event_id AS "Seq", user_id % 3 AS "Partition", event_id // 8 AS "Offset"
    FROM events"""

HASH = """sha256(concat_ws('|', event_type, CAST(epoch_us(ts) // 1000 AS VARCHAR), printf('%.10f', value),
           printf('%.10f', CAST(json_extract_string(props, '$.k') AS DOUBLE)),
           CAST(to_json([event_type]) AS VARCHAR)))"""

INGEST = "ts + to_milliseconds(CAST(json_extract_string(props, '$.k') AS BIGINT))"
INGEST_TEXT = f"strftime({INGEST} + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00'"

FLAT = f"""
    SELECT event_type AS "Symbol", value AS "Price",
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "Volume", ts AS "Trade_Time",
           event_id AS "Seq", CAST(user_id % 3 AS INTEGER) AS "Partition", event_id // 8 AS "Offset",
           CAST(to_json([event_type]) AS VARCHAR) AS "Trade_type",
           {INGEST_TEXT} AS "Timestamp_Web",
           {HASH} AS "Hash_Spark",
           CASE WHEN event_id % 97 = 0 THEN '0' ELSE {HASH} END AS "Hash_Web"
    FROM events"""

LINEITEM = """
    SELECT CAST(l_suppkey AS VARCHAR) AS "Symbol", l_extendedprice AS "Price", l_quantity AS "Volume",
           l_shipdate AS "Trade_Time",
           (l_orderkey * 8 + l_linenumber) * 16777216 + CAST(round(l_extendedprice * 100) AS BIGINT) AS "Seq"
    FROM lineitem"""

ORDERS = """
    SELECT o_orderpriority AS "Symbol", o_totalprice AS "Price", CAST(1 AS DOUBLE) AS "Volume",
           o_orderdate AS "Trade_Time", o_orderkey AS "Seq"
    FROM orders"""


def bars(interval: str, source: str = "ticks") -> str:
    return f"""
    SELECT "Symbol", time_bucket(INTERVAL '{interval}', "Trade_Time") AS "time",
           arg_min("Price", ("Trade_Time", "Seq")) AS "Open", max("Price") AS "High", min("Price") AS "Low",
           arg_max("Price", ("Trade_Time", "Seq")) AS "Close", sum("Volume") AS "Total_Volume"
    FROM {source} GROUP BY 1, 2"""


def rounded_bars(interval: str, ticks: str = PLAIN) -> str:
    return f"""WITH ticks AS ({ticks}), bars AS ({bars(interval)})
SELECT "Symbol", "time", {ROUNDED} FROM bars"""


def averages(windows=(5, 10, 20, 60), digits: int | None = 4) -> str:
    terms = []
    for n in windows:
        frame = f'(PARTITION BY "Symbol" ORDER BY "time" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'
        mean = f'avg("Close") OVER {frame}'
        mean = mean if digits is None else f"round({mean}, {digits})"
        terms.append(f'CASE WHEN count("Close") OVER {frame} = {n} THEN {mean} END AS "MA_{n}"')
    return ", ".join(terms)


def averaged_bars(interval: str) -> str:
    return f"""WITH ticks AS ({PLAIN}), bars AS ({bars(interval)})
SELECT "Symbol", "time", {ROUNDED}, {averages()} FROM bars"""


def fields(table: str, names: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(f"'{n}=' || CAST({table}.\"{n}\" AS VARCHAR)" for n in names) + ")"


MICROBATCH = f"""WITH ticks AS ({FLAT}), last AS (SELECT max("Trade_Time") AS now FROM ticks),
bars AS (
    SELECT "Symbol", time_bucket(INTERVAL '5 seconds', any_value(now)) - INTERVAL 5 SECOND AS "time",
           arg_min("Price", ("Trade_Time", "Seq")) AS "Open", max("Price") AS "High", min("Price") AS "Low",
           arg_max("Price", ("Trade_Time", "Seq")) AS "Close", sum("Volume") AS "Total_Volume",
           strftime(any_value(now) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%g') AS "Spark_Time",
           min("Timestamp_Web") AS "Start_Time", max("Timestamp_Web") AS "End_Time"
    FROM ticks, last GROUP BY 1)
"""

MICROBATCH_STEPS = f"""WITH ticks AS ({FLAT}), span AS (
    SELECT min(epoch_us("Trade_Time")) AS low, max(epoch_us("Trade_Time")) AS high FROM ticks),
steps AS (SELECT ticks.*, (epoch_us("Trade_Time") - low) // ((high - low) // 4 + 1) AS step FROM ticks, span),
bars AS (
    SELECT "Symbol", time_bucket(INTERVAL '5 seconds', max("Trade_Time")) - INTERVAL 5 SECOND AS "time",
           arg_min("Price", ("Trade_Time", "Seq")) AS "Open", max("Price") AS "High", min("Price") AS "Low",
           arg_max("Price", ("Trade_Time", "Seq")) AS "Close", sum("Volume") AS "Total_Volume",
           strftime(max("Trade_Time") + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%g') AS "Spark_Time",
           min("Timestamp_Web") AS "Start_Time", max("Timestamp_Web") AS "End_Time"
    FROM steps GROUP BY "Symbol", step)
"""

YESTERDAY_TOP = f"""WITH ticks AS ({LINEITEM}),
top AS (
    SELECT "Symbol", sum("Volume") AS v FROM ticks
    WHERE CAST("Trade_Time" AS DATE) = (SELECT CAST(max("Trade_Time") AS DATE) FROM ticks)
    GROUP BY 1 ORDER BY v DESC, "Symbol" LIMIT 50)
"""

ALL_LEVELS = " UNION ALL ".join(
    f"""SELECT '{interval}' AS "interval", "Symbol", "time", {ROUNDED} FROM ({bars(interval)})"""
    for interval in ("5 seconds", "1 minute", "5 minutes", "15 minutes", "1 hour")
)
COARSE_LEVELS = ALL_LEVELS.split(" UNION ALL ", 1)[1]


def stale(threshold: str, keys: str = "", now: bool = False) -> str:
    partition = f"PARTITION BY {keys}" if keys else ""
    prefix = f"{keys}, " if keys else ""
    rows = f'SELECT {prefix}"Trade_Time" AS seen_at FROM ticks'
    if now:
        newest = '(SELECT max("Trade_Time") FROM ticks)'
        rows += f""" UNION ALL SELECT {prefix}{newest} FROM ticks
        GROUP BY {keys} HAVING max("Trade_Time") < {newest}"""
    return f"""WITH ticks AS ({PLAIN}), seen AS ({rows}),
paired AS (SELECT {prefix}lag(seen_at) OVER ({partition} ORDER BY seen_at) AS gap_start, seen_at AS gap_end FROM seen)
SELECT {prefix}gap_start, gap_end, epoch_us(gap_end) - epoch_us(gap_start) AS gap_micros
FROM paired WHERE gap_end - gap_start > INTERVAL '{threshold}'"""


CLOCK = "strftime({} + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%g')"


def point_ns(tags: str, order: str) -> str:
    return f"""(epoch_us("Trade_Time") // 1000 * 1000000 + row_number() OVER (
        PARTITION BY {tags}, epoch_us("Trade_Time") // 1000 ORDER BY "Trade_Time", {order}) - 1)"""


def all_averaged(since: dict[str, str] | None = None) -> str:
    """All levels with averages; ``since``: how long before the newest tick averages begin, if not at once."""
    parts = []
    for interval in ("5 seconds", "1 minute", "5 minutes", "15 minutes", "1 hour"):
        edge = "TIMESTAMP '1900-01-01'"
        if since:
            edge = (f"(SELECT time_bucket(INTERVAL '{interval}', max(\"Trade_Time\") - INTERVAL '{since[interval]}') "
                    "FROM ticks)")
        shown = ", ".join(f'CASE WHEN "time" >= {edge} THEN "MA_{n}" END AS "MA_{n}"' for n in (5, 10, 20, 60))
        parts.append(f"""SELECT '{interval}' AS "interval", "Symbol", "time", {ROUNDED}, {shown}
FROM (SELECT *, {averages()} FROM ({bars(interval)}))""")
    return f"WITH ticks AS ({PLAIN}) " + " UNION ALL ".join(parts)


def closed_levels(delay: str) -> str:
    """Bars of each level that are finished when the newest tick, less ``delay``, has been seen."""
    steps, shown = [f"ticks AS ({PLAIN})"], []
    limit = f"""(SELECT max("Trade_Time") - INTERVAL '{delay}' FROM ticks)"""
    for place, interval in enumerate(("5 seconds", "1 minute", "5 minutes", "15 minutes", "1 hour")):
        steps.append(f"""level{place} AS (SELECT * FROM ({bars(interval)})
            WHERE "time" + INTERVAL '{interval}' <= {limit})""")
        limit = f"""(SELECT max("time" + INTERVAL '{interval}') - INTERVAL '1 millisecond' FROM level{place})"""
        shown.append(f"""SELECT '{interval}' AS "interval", "Symbol", "time", {ROUNDED} FROM level{place}""")
    return "WITH " + ", ".join(steps) + " " + " UNION ALL ".join(shown)


LOOKBACKS = {"5 seconds": "10 minutes", "1 minute": "2 hours", "5 minutes": "4 hours", "15 minutes": "8 hours",
             "1 hour": "70 hours"}

ORACLES: dict[str, str] = {
    "flatten_ticks": f"""WITH ticks AS ({FLAT})
SELECT "Trade_type", round("Price", 4) AS "Price", "Symbol", round("Volume", 4) AS "Volume",
       date_trunc('milliseconds', "Trade_Time") AS "Trade_Time", "Hash_Web", "Seq",
       min("Timestamp_Web") OVER (PARTITION BY "Partition", "Offset") AS "Timestamp_Web",
       "Offset", "Partition", "Hash_Spark"
FROM ticks""",
    "build_envelopes": f"""WITH ticks AS ({FLAT})
SELECT "Partition" AS "partition", "Offset" AS "offset", CAST(count(*) AS INTEGER) AS n_ticks
FROM ticks GROUP BY 1, 2""",
    "decode_json_trades": """SELECT event_id, epoch_us(ts) // 1000 AS t, event_type AS s, round(value, 4) AS p,
       round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 4) AS v,
       CAST(to_json([event_type]) AS VARCHAR) AS c
FROM events WHERE event_id % 17 <> 0 AND event_id % 10 <> 0""",
    "decode_json_bad": """SELECT event_id, '{"type":"trade","data":[' || CAST(event_id AS VARCHAR) AS "value"
FROM events WHERE event_id % 17 = 0""",
    "lookup_offset": f"""WITH ticks AS ({FLAT})
SELECT "Partition", "Offset",
       CAST(row_number() OVER (PARTITION BY "Partition", "Offset" ORDER BY "Seq") - 1 AS INTEGER) AS "Position",
       "Symbol", round("Price", 4) AS "Price", round("Volume", 4) AS "Volume", "Seq", "Hash_Web" AS "Hash"
FROM ticks WHERE "Partition" = 1 AND "Offset" = 42""",
    "tick_hash": f"""SELECT event_id AS "Seq", {HASH} AS "Hash_Spark" FROM events""",
    "kst_shift": """SELECT event_id AS "Seq", ts + INTERVAL 9 HOUR AS market_time, ts AS utc_time FROM events""",
    "epoch_ns": """SELECT event_id AS "Seq", epoch_us(ts) * 1000 AS ns,
       date_trunc('milliseconds', ts) AS ms_time FROM events""",
    "bucket_label": """SELECT event_id AS "Seq", time_bucket(INTERVAL '5 seconds', ts) AS bucket,
       time_bucket(INTERVAL '5 seconds', ts) - INTERVAL 5 SECOND AS label FROM events""",
    "time_text": """SELECT event_id AS "Seq", strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%g') AS clock,
       strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+09:00' AS iso FROM events""",
    "parse_time": """SELECT event_id AS "Seq", CASE WHEN event_id % 19 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts END AS parsed FROM events""",
    "tick_bars_5s": rounded_bars("5 seconds"),
    "tick_bars_1h": rounded_bars("1 hour"),
    "tick_bars_1d": rounded_bars("1 day"),
    "tick_bars_lineitem_1d": rounded_bars("1 day", LINEITEM),
    "tick_bars_orders_1d": rounded_bars("1 day", ORDERS),
    "start_end_time": f"""WITH ticks AS ({FLAT})
SELECT "Symbol", time_bucket(INTERVAL '1 hour', "Trade_Time") AS "time",
       min("Timestamp_Web") AS "Start_Time", max("Timestamp_Web") AS "End_Time"
FROM ticks GROUP BY 1, 2""",
    "microbatch_bars": MICROBATCH + f"""SELECT "Symbol", "time", {ROUNDED}, "Spark_Time", "Start_Time", "End_Time" FROM bars""",
    "rollup_1m": rounded_bars("1 minute"),
    "rollup_5m": rounded_bars("5 minutes"),
    "rollup_15m": rounded_bars("15 minutes"),
    "rollup_1h": rounded_bars("1 hour"),
    "bar_pyramid": f"WITH ticks AS ({PLAIN}) {COARSE_LEVELS}",
    "bar_tables": f"WITH ticks AS ({PLAIN}) {ALL_LEVELS}",
    "recent_ticks": f"""WITH ticks AS ({PLAIN})
SELECT "Symbol", round("Price", 4) AS "Price", round("Volume", 4) AS "Volume", "Trade_Time", "Seq"
FROM ticks WHERE "Trade_Time" >= (SELECT max("Trade_Time") - INTERVAL 5 SECOND FROM ticks)""",
    "lookback_bars": f"""WITH every AS ({PLAIN}), ticks AS (
    SELECT * FROM every
    WHERE "Trade_Time" >= (SELECT time_bucket(INTERVAL '1 hour', max("Trade_Time") - INTERVAL 70 HOUR) FROM every)),
bars AS ({bars("1 hour")})
SELECT "Symbol", "time", {ROUNDED} FROM bars""",
    "moving_averages": averaged_bars("1 hour"),
    "moving_averages_5s": averaged_bars("5 seconds"),
    "assign_seq": """SELECT CAST(user_id % 3 AS INTEGER) AS "Partition", event_type AS "Symbol", ts AS "Trade_Time",
       event_id, row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) AS "Seq"
FROM events""",
    "daily_volume": f"""WITH ticks AS ({LINEITEM})
SELECT date_trunc('day', "Trade_Time") AS "date", "Symbol" AS "T", round(sum("Volume"), 4) AS v
FROM ticks GROUP BY 1, 2""",
    "top_symbols": f"""WITH ticks AS ({LINEITEM})
SELECT "Symbol", round(sum("Volume"), 4) AS v FROM ticks
GROUP BY 1 ORDER BY sum("Volume") DESC, "Symbol" LIMIT 50""",
    "top_symbols_yesterday": YESTERDAY_TOP + """SELECT "Symbol", round(v, 4) AS v FROM top""",
    "in_universe": YESTERDAY_TOP + """SELECT "Symbol", round("Price", 4) AS "Price", round("Volume", 4) AS "Volume",
       "Trade_Time", "Seq"
FROM ticks WHERE "Symbol" IN (SELECT "Symbol" FROM top)""",
    "line_protocol": f"""WITH averaged AS ({averaged_bars("1 hour")})
SELECT '1h-monitor,Symbol=' || "Symbol" || ' '
       || {fields("averaged", ["Open", "High", "Low", "Close", "Total_Volume", "MA_5", "MA_10", "MA_20", "MA_60"])}
       || ' ' || CAST(epoch_us("time") * 1000 AS VARCHAR) AS line
FROM averaged""",
    "line_protocol_raw": f"""WITH ticks AS ({FLAT})
SELECT 'raw,Symbol=' || "Symbol" || ',Partition=' || CAST("Partition" AS VARCHAR)
       || ' Trade_type="' || replace("Trade_type", '"', '\\"') || '",Price=' || CAST("Price" AS VARCHAR)
       || ',Volume=' || CAST("Volume" AS VARCHAR) || ',Trade_Time="' || {CLOCK.format('"Trade_Time"')}
       || '",Timestamp_Web="' || "Timestamp_Web"
       || '",Spark_Time="' || {CLOCK.format('(SELECT max("Trade_Time") FROM ticks)')} || '",Hash_Web="' || "Hash_Web" || '",Hash_Spark="' || "Hash_Spark"
       || '",Seq=' || CAST("Seq" AS VARCHAR) || ',Offset=' || CAST("Offset" AS VARCHAR)
       || ' ' || CAST({point_ns('"Symbol", "Partition"', '"Seq"')} AS VARCHAR) AS line
FROM ticks""",
    "raw_point_times": f"""WITH ticks AS ({LINEITEM})
SELECT "Symbol", "Seq", "Volume", {point_ns('"Symbol"', '"Seq", "Volume"')} AS point_ns FROM ticks""",
    "upsert_bars": f"""WITH ticks AS ({PLAIN}), bars AS ({bars("1 hour")}),
old AS (SELECT *, {averages((5,), None)} FROM bars),
higher AS (SELECT * FROM ticks WHERE "Price" >= 10),
late AS ({bars("1 hour", "higher")}),
fresh AS (SELECT * REPLACE ("time" + INTERVAL 1 HOUR AS "time") FROM late)
SELECT coalesce(fresh."Symbol", old."Symbol") AS "Symbol", coalesce(fresh."time", old."time") AS "time",
       round(coalesce(fresh."Open", old."Open"), 4) AS "Open",
       round(coalesce(fresh."High", old."High"), 4) AS "High",
       round(coalesce(fresh."Low", old."Low"), 4) AS "Low",
       round(coalesce(fresh."Close", old."Close"), 4) AS "Close",
       round(coalesce(fresh."Total_Volume", old."Total_Volume"), 4) AS "Total_Volume",
       round(old."MA_5", 4) AS "MA_5"
FROM old FULL JOIN fresh ON old."Symbol" = fresh."Symbol" AND old."time" = fresh."time" """,
    "scan_ticks": f"""WITH ticks AS ({PLAIN})
SELECT "Symbol", round("Price", 4) AS "Price", round("Volume", 4) AS "Volume", "Trade_Time", "Seq"
FROM ticks WHERE "Trade_Time" >= (SELECT max("Trade_Time") - INTERVAL 70 HOUR FROM ticks)""",
    "scan_bars": f"""WITH ticks AS ({PLAIN}), bars AS ({bars("1 minute")})
SELECT "Symbol", "time", {ROUNDED} FROM bars
WHERE "time" >= (SELECT time_bucket(INTERVAL '5 minutes', max("Trade_Time") - INTERVAL 4 HOUR) FROM ticks)""",
    "refresh_bars": all_averaged(LOOKBACKS),
    "hash_mismatch": f"""WITH ticks AS ({FLAT})
SELECT "Seq", "Symbol", "Hash_Web", "Hash_Spark" FROM ticks WHERE "Hash_Web" <> "Hash_Spark" """,
    "seq_gaps": f"""WITH ticks AS ({FLAT}),
paired AS (
    SELECT "Partition", lag("Seq") OVER (PARTITION BY "Partition" ORDER BY "Timestamp_Web", "Seq") AS after_seq,
           "Seq" AS next_seq
    FROM ticks)
SELECT "Partition", after_seq, next_seq, next_seq - after_seq - 1 AS missing
FROM paired WHERE next_seq - after_seq > 1""",
    "stale_intervals": stale("60 seconds"),
    "stale_by_symbol": stale("10 minutes", '"Symbol"', now=True),
    "latency": f"""WITH seen AS (
    SELECT event_type AS "Symbol",
           CAST(floor((epoch_us(date_trunc('milliseconds', {INGEST})) - epoch_us(ts)) / 1000.0) AS BIGINT) AS ms
    FROM events),
ranked AS (
    SELECT "Symbol", ms, row_number() OVER (PARTITION BY "Symbol" ORDER BY ms) AS place,
           count(*) OVER (PARTITION BY "Symbol") AS total
    FROM seen)
SELECT "Symbol", count(*) AS n, min(ms) AS min_ms, round(avg(ms), 4) AS mean_ms, max(ms) AS max_ms,
       min(ms) FILTER (WHERE place >= ceil(CAST(0.5 AS DOUBLE) * total)) AS p50_ms,
       min(ms) FILTER (WHERE place >= ceil(CAST(0.95 AS DOUBLE) * total)) AS p95_ms
FROM ranked GROUP BY 1""",
    "latency_stored": f"""WITH seen AS (
    SELECT event_type AS "Symbol",
           CAST(floor((epoch_us(date_trunc('milliseconds', {INGEST})) - epoch_us(ts)) / 1000.0) AS BIGINT) AS ms,
           floor((epoch_us((SELECT max(ts) FROM events)) - epoch_us(date_trunc('milliseconds', {INGEST}))) / 1000.0) AS leg
    FROM events),
ranked AS (
    SELECT "Symbol", ms, leg, row_number() OVER (PARTITION BY "Symbol" ORDER BY ms) AS place,
           count(*) OVER (PARTITION BY "Symbol") AS total
    FROM seen)
SELECT "Symbol", count(*) AS n, min(ms) AS min_ms, round(avg(ms), 4) AS mean_ms, max(ms) AS max_ms,
       min(ms) FILTER (WHERE place >= ceil(CAST(0.5 AS DOUBLE) * total)) AS p50_ms,
       min(ms) FILTER (WHERE place >= ceil(CAST(0.95 AS DOUBLE) * total)) AS p95_ms,
       round(avg(leg), 4) AS spark_mean_ms
FROM ranked GROUP BY 1""",
    "progress_offsets": f"""WITH ticks AS ({PLAIN})
SELECT 'raw' AS "query", time_bucket(INTERVAL '1 hour', "Trade_Time") AS "timestamp", 'stock_data' AS topic,
       CAST("Partition" AS VARCHAR) AS "partition", max("Offset") AS "offset"
FROM ticks GROUP BY ALL""",
    "latest_offsets": f"""WITH ticks AS ({PLAIN}), hourly AS (
    SELECT "Partition", time_bucket(INTERVAL '1 hour', "Trade_Time") AS hour_start, max("Offset") AS o FROM ticks GROUP BY ALL)
SELECT 'raw' AS "query", 'stock_data' AS topic, CAST("Partition" AS VARCHAR) AS "partition",
       arg_max(o, hour_start) AS "offset"
FROM hourly GROUP BY "Partition" """,
    "stream_raw": f"""WITH ticks AS ({FLAT})
SELECT "Trade_type", round("Price", 4) AS "Price", "Symbol", round("Volume", 4) AS "Volume", "Trade_Time",
       "Hash_Web", "Seq", "Timestamp_Web", "Offset", "Partition", "Hash_Spark"
FROM ticks""",
    "raw_backfill": f"""WITH ticks AS ({FLAT})
SELECT "Trade_type", round("Price", 4) AS "Price", "Symbol", round("Volume", 4) AS "Volume", "Trade_Time",
       "Hash_Web", "Seq", "Timestamp_Web", "Offset", "Partition", "Hash_Spark"
FROM ticks""",
    "stream_microbatch": MICROBATCH + f"""SELECT "Symbol", "time", {ROUNDED}, "Spark_Time", "Start_Time", "End_Time",
       table_name
FROM bars, (VALUES ('5sec'), ('5sec-monitor')) AS tables(table_name)""",
    "stream_bars": rounded_bars("1 hour"),
    "stream_refresh_ma": all_averaged(),
    "stream_cascade": closed_levels("10 days"),
}
ORACLES |= {
    "stream_raw_and_bars": ORACLES["stream_raw"],
    "stream_observed": f"""WITH ticks AS ({FLAT})
SELECT 'raw' AS "name", count(*) AS ticks, count(*) FILTER ("Price" IS NULL OR isnan("Price")) AS no_price,
       count(*) FILTER ("Hash_Web" IS DISTINCT FROM "Hash_Spark") AS "foreign"
FROM ticks""",
    "recent_ticks_1d": ORACLES["recent_ticks"].replace("INTERVAL 5 SECOND", "INTERVAL 1 DAY"),
    "stream_microbatch_steps": MICROBATCH_STEPS + ORACLES["stream_microbatch"].removeprefix(MICROBATCH),
    "stream_stale": ORACLES["stale_intervals"],
    "stream_seq_gaps": ORACLES["seq_gaps"],
    "stream_assign_seq": ORACLES["assign_seq"],
    "stream_late_bars": ORACLES["stream_bars"],
}
