"""Queries over the test tables, one per operator, each on whole tables.

The tables play the ticks: ``events`` has time ``ts``, market ``user_id`` or
``event_type``, price ``value`` and volume ``k`` inside the JSON text ``props``;
``lineitem`` has time ``l_shipdate``, market ``l_suppkey``, price
``l_extendedprice`` and volume ``l_quantity``. Their times carry no zone, and so
do the results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickflow.config import JobConfig, exchange_a, exchange_b
from tickflow.functions.accounting import Account
from tickflow.functions.codec import (
    decode_first,
    decode_json,
    decode_listing,
    encode_json,
)
from tickflow.functions.scalar import date_keys, event_time, floor_double, notional, wall_clock
from tickflow.operators.markets import (
    attach_name,
    common_markets,
    join_quotes,
    krw_markets,
    last_by_key,
    missing_quotes,
)
from tickflow.operators.notional import undated, windowed_notional
from tickflow.operators.rank import rank_all, top_n
from tickflow.plans.newest import newest_file, newest_window
from tickflow.plans.producers import polled_messages, pushed_messages
from tickflow.plans.ticks import decode_ticks, top_markets
from tickflow.schemas import LISTING, POLLED, PUSHED, TICKS_A, struct
from tickflow.scratch import new_folder
from tickflow.session import SEOUL, tick_session
from tickflow.sinks.manifest import Store
from tickflow.sinks.messages import publish_to_folder, stream_to_folder
from tickflow.sinks.published import (
    compact_days,
    marked_days,
    publish_result,
    result_columns,
    write_published,
)
from tickflow.sources.payloads import read_markets
from tickflow.sources.published import read_day, read_published
from tickflow.sources.state import open_groups
from tickflow.sources.ticks import landed_messages, stored_messages
from tickflow.jobs.gate import late_ticks, start_gate
from tickflow.jobs.job import run_available, start_chained
from tickflow.jobs.latest import read_latest, start_latest

Query = Callable[[SparkSession, str], DataFrame]

PROPS = struct("k long")

# A continuous query that works off what is there and stops.
ONCE = {"availableNow": True}

# Even the smallest test tables take the shuffled path.
SPLIT = {"max_rows": 0}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- the tables as ticks ----------------------------------------------------------


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` with the decoded volume."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return decode_json(table(spark, folder, "events"), PROPS, value="props", keep=columns)


def _millis(time: str) -> Column:
    return F.unix_millis(F.col(time).cast("timestamp"))


def _krw(code: str) -> Column:
    return F.concat(F.lit("KRW-"), F.col(code).cast("string"))


def event_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as quotes of the polled exchange, one market per user."""
    return event_ticks(spark, folder).select(
        "event_id",
        _krw("user_id").alias("market"),
        F.col("event_type").alias("name"),
        F.col("value").alias("trade_price"),
        F.col("k").cast("double").alias("trade_volume"),
        _millis("ts").alias("timestamp"),
    )


def stored_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")


def supplier_days(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    """Notional per supplier and day of ``lineitem``."""
    return windowed_notional(
        table(spark, folder, "lineitem"),
        time="l_shipdate",
        price="l_extendedprice",
        volume="l_quantity",
        keys=[F.col("l_suppkey").alias("market")],
        duration="1 day",
        exact=exact,
    )


def event_result(spark: SparkSession, folder: str) -> DataFrame:
    """The published form of the five top users of every minute of ``events``."""
    top = top5_minute(spark, folder)
    return result_columns(top.withColumn("market", F.col("market").cast("string")))


def _last_day(result: DataFrame) -> tuple[str, str, str]:
    last = result.agg(F.max("window_start").alias("time")).select(*date_keys("time")).first()
    return tuple(last)


# --- decode and encode ------------------------------------------------------------


def decode_events(spark: SparkSession, folder: str) -> DataFrame:
    return decode_json(table(spark, folder, "events"), PROPS, value="props", keep=["event_id"])


def _faulty_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with faults by event type: cut off, blank, bad price, price as text."""
    quotes = event_quotes(spark, folder)
    price = (
        F.when(F.col("name") == "click", F.lit("n/a"))
        .otherwise(F.col("trade_price").cast("string"))
    )
    plain = F.to_json(F.struct("market", "trade_price", "trade_volume", "timestamp", "event_id"))
    text = F.to_json(F.struct("market", price.alias("trade_price"), "trade_volume", "timestamp"))
    value = (
        F.when(F.col("name") == "error", F.expr("substr(text, 1, length(text) - 1)"))
        .when(F.col("name").isin("click", "view"), F.col("text"))
        .when(F.col("name") == "signup", F.lit("  "))
        .otherwise(F.col("plain"))
    )
    return quotes.select("event_id", "name", plain.alias("plain"), text.alias("text")).select(
        "event_id", value.alias("value")
    )


def decode_lenient(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["market", "trade_price", "trade_volume", "timestamp", "name"]
    return decode_json(_faulty_messages(spark, folder), TICKS_A, wanted, keep=["event_id"])


def decode_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """What the decoder left out of faulty messages, counted while they are summed. Odd ones
    have a time that no timestamp holds, every fourth one has a word for a time."""
    time = (
        F.when(F.col("event_id") % 2 == 1, F.lit("9223372036854775807"))
        .when(F.col("event_id") % 4 == 0, F.lit('"soon"'))
        .otherwise(F.lit("$1"))
    )
    value = F.regexp_replace("value", F.lit(r'(?<="timestamp":)(\d+)'), time)
    messages = _faulty_messages(spark, folder).select(value.alias("value"))
    account = Account("faulty", time="timestamp")
    ticks = decode_ticks(messages, POLLED, account=account)
    windowed_notional(ticks, duration="1 day").write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(account.counts().items()), "counted string, n long")


def undated_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Messages whose time is missing or no timestamp are set apart."""
    quotes = event_quotes(spark, folder)
    time = (
        F.when(F.col("name") == "error", F.lit(None).cast("bigint"))
        .when(F.col("name") == "click", F.lit(2**63 - 1))
        .otherwise(F.col("timestamp"))
    )
    ticks = decode_ticks(encode_json(quotes.withColumn("timestamp", time)), POLLED)
    return undated(ticks).select("market", "name", "trade_price", "trade_volume")


def listing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One listing payload per part, with two markets each."""

    def entry(prefix: str) -> Column:
        market = F.concat(F.lit(prefix), F.col("p_partkey").cast("string"))
        return F.struct(
            market.alias("market"),
            F.col("p_name").alias("korean_name"),
            F.col("p_brand").alias("english_name"),
        )

    payloads = table(spark, folder, "part").select(
        "p_partkey", F.to_json(F.array(entry("KRW-"), entry("BTC-"))).alias("value")
    )
    return decode_listing(payloads, LISTING, keep=["p_partkey"])


def _quote_payloads(quotes: DataFrame) -> DataFrame:
    fields = ["market", "trade_price", "trade_volume", "timestamp"]
    other = F.struct(*[F.lit(None).cast(TICKS_A[f].dataType).alias(f) for f in fields])
    return quotes.select(
        "event_id", F.to_json(F.array(F.struct(*fields), other)).alias("value")
    )


def first_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per event; only its first quote counts."""
    payloads = _quote_payloads(event_quotes(spark, folder))
    return decode_first(payloads, TICKS_A, keep=["event_id"]).select(
        "event_id", "market", "trade_price", "trade_volume", "timestamp"
    )


def encode_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", "props"
    )
    schema = struct(
        "event_id long, user_id long, event_type string, value double, props string"
    )
    return decode_json(encode_json(events), schema)


def publish_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages written to a landing folder and read back."""
    landing = new_folder(spark, "landing")
    publish_to_folder(event_quotes(spark, folder), landing, POLLED.needed)
    return decode_json(stored_messages(spark, landing), TICKS_A, POLLED.needed)


# --- projections ------------------------------------------------------------------


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", _millis("ts").alias("timestamp"))
    return events.select("event_id", wall_clock(event_time("timestamp")).alias("event_time"))


def tick_notional(spark: SparkSession, folder: str) -> DataFrame:
    product = notional("l_extendedprice", "l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        product.alias("notional"),
        floor_double(product).alias("whole_notional"),
    )


def partition_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", *date_keys("o_orderdate"))


def prefix_filter(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return krw_markets(parts, market="p_name", name="p_brand", prefix="red", keep=["p_partkey"])


# --- joins ------------------------------------------------------------------------


def _urgent(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("market")
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("market"), F.col("c_name").alias("name")
    )


def _builders(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return customers.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("market"), F.col("c_name").alias("name")
    )


def common_keys(spark: SparkSession, folder: str, **limits) -> DataFrame:
    return common_markets(_customers(spark, folder), _urgent(spark, folder), **limits)


def common_keys_split(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose customer is in the building trade, on the split path."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("market"), "o_orderkey")
    return common_markets(orders, _builders(spark, folder), **SPLIT)


def attach_names(spark: SparkSession, folder: str, **limits) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return attach_name(orders, _builders(spark, folder), "o_custkey", **limits)


def attach_names_split(spark: SparkSession, folder: str) -> DataFrame:
    return attach_names(spark, folder, **SPLIT)


def join_prices(spark: SparkSession, folder: str, **limits) -> DataFrame:
    """Line items of the suppliers with a positive balance, with the supplier's name."""
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0)
    listing = suppliers.select(F.col("s_suppkey").alias("market"), F.col("s_name").alias("name"))
    quotes = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("market"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("trade_price"),
    )
    return join_quotes(listing, quotes, **limits)


def join_prices_split(spark: SparkSession, folder: str) -> DataFrame:
    return join_prices(spark, folder, **SPLIT)


def missing_prices(spark: SparkSession, folder: str, **limits) -> DataFrame:
    return missing_quotes(_customers(spark, folder), _urgent(spark, folder), **limits)


def missing_prices_split(spark: SparkSession, folder: str) -> DataFrame:
    return missing_prices(spark, folder, **SPLIT)


# --- aggregates and ranks ---------------------------------------------------------


def last_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return last_by_key(stored_events(spark, folder), "user_id", ["ts", "event_id"])


def notional_minute(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_notional(
        event_ticks(spark, folder),
        time="ts",
        price="value",
        volume="k",
        keys=[F.col("user_id").alias("market"), F.col("event_type").alias("name")],
    )


def notional_day(spark: SparkSession, folder: str) -> DataFrame:
    return supplier_days(spark, folder)


def notional_exact_day(spark: SparkSession, folder: str) -> DataFrame:
    """The same with sums that do not depend on the order of addition."""
    return supplier_days(spark, folder, exact=True)


def rank_all_day(spark: SparkSession, folder: str) -> DataFrame:
    return rank_all(supplier_days(spark, folder), ties=["market"])


def top5_minute(spark: SparkSession, folder: str) -> DataFrame:
    return top_n(notional_minute(spark, folder))


def top5_day(spark: SparkSession, folder: str) -> DataFrame:
    return top_n(supplier_days(spark, folder), ties=["market"])


def top5_day_events(spark: SparkSession, folder: str) -> DataFrame:
    days = windowed_notional(
        event_ticks(spark, folder),
        time="ts",
        price="value",
        volume="k",
        keys=[F.col("user_id").alias("market"), F.col("event_type").alias("name")],
        duration="1 day",
    )
    return top_n(days)


# --- message to result ------------------------------------------------------------


def polled_top5_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Listing and quote payloads of the polled exchange, joined, sent as messages,
    decoded and ranked. A customer is a market; builders are quoted in won."""
    customers = table(spark, folder, "customer")
    prefix = F.when(F.col("c_mktsegment") == "BUILDING", "KRW-").otherwise("BTC-")
    entry = F.struct(
        F.concat(prefix, F.col("c_custkey").cast("string")).alias("market"),
        F.col("c_name").alias("korean_name"),
        F.col("c_mktsegment").alias("english_name"),
    )
    payloads = customers.select(F.to_json(F.array(entry)).alias("value"))
    rows = decode_listing(payloads, LISTING)
    listing = last_by_key(krw_markets(rows, keep=["position"]), "market", ["position"])

    payloads = _quote_payloads(event_quotes(spark, folder))
    return top_markets(polled_messages(listing, payloads), exchange_a("", ""))


def pushed_top5_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of the pushing exchange, named from the listing, decoded and ranked."""
    frames = encode_json(event_quotes(spark, folder).withColumnRenamed("market", "code"))
    names = _builders(spark, folder).select(_krw("market").alias("market"), "name")
    return top_markets(pushed_messages(frames, names), exchange_b("", ""))


def _odd_quotes(quotes: DataFrame, code: str) -> Column:
    """A quote with a field that no schema declares and a price that is no number."""
    fields = [F.col("market").alias(code), "trade_volume", "timestamp"]
    odd = [F.lit("n/a").alias("high_price"), F.struct("event_id").alias("origin")]
    return F.struct(*fields, F.col("name"), *odd)


def _message_fields(messages: DataFrame, code: str) -> DataFrame:
    schema = f"{code} string, trade_volume double, name string, high_price string, origin struct<event_id: long>"
    parsed = messages.select(F.from_json("value", schema).alias("m")).select("m.*")
    return parsed.select(
        F.col(code).alias("market"), "trade_volume", "name", "high_price", "origin.event_id"
    )


def polled_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """What a polled message holds besides its name stays as it came."""
    quotes = event_quotes(spark, folder)
    payloads = quotes.select(F.to_json(F.array(_odd_quotes(quotes, "market"))).alias("value"))
    listing = _builders(spark, folder).select(_krw("market").alias("market"), "name")
    return _message_fields(polled_messages(listing, payloads), "market")


def pushed_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a pushed frame; markets without a name lose the one they came with."""
    quotes = event_quotes(spark, folder)
    frames = quotes.select(F.to_json(_odd_quotes(quotes, "code")).alias("value"))
    names = _builders(spark, folder).select(_krw("market").alias("market"), "name")
    return _message_fields(pushed_messages(frames, names), "code")


def newest_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Every brand is a listing in a folder of them; only the newest counts. The files' times
    run against their names."""
    listings = new_folder(spark, "listings")
    entry = F.struct(_krw("p_partkey").alias("market"), F.col("p_name").alias("korean_name"))
    brands = table(spark, folder, "part").groupBy("p_brand").agg(F.to_json(F.collect_list(entry)).alias("value"))
    brands.write.partitionBy("p_brand").text(listings)
    store = Store(spark, listings)
    for second, path in enumerate(sorted(store.found(f"{listings}/*/*.txt"), reverse=True)):
        store.set_time(path, 1_700_000_000_000 + second * 1000)
    return read_markets(spark, listings)


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    """Notional per user and day: far more than five markets in every window."""
    return windowed_notional(
        event_ticks(spark, folder),
        time="ts",
        price="value",
        volume="k",
        keys=[_krw("user_id").alias("market"), F.col("event_type").alias("name")],
        duration="1 day",
    )


def polled_top5_day(spark: SparkSession, folder: str) -> DataFrame:
    """Polled quotes of all markets as messages, ranked by day."""
    quotes = event_quotes(spark, folder)
    listing = quotes.select("market").distinct().select("market", F.col("market").alias("name"))
    messages = polled_messages(listing, _quote_payloads(quotes))
    return top_markets(messages, exchange_a("", "", duration="1 day"))


def pushed_top5_day(spark: SparkSession, folder: str) -> DataFrame:
    frames = encode_json(event_quotes(spark, folder).withColumnRenamed("market", "code"))
    names = _builders(spark, folder).select(_krw("market").alias("market"), "name")
    return top_markets(pushed_messages(frames, names), exchange_b("", "", duration="1 day"))


def top5_day_seoul(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the Seoul clock, from messages."""
    messages = encode_json(event_quotes(spark, folder), POLLED.needed)
    landing = new_folder(spark, "landing")
    publish_to_folder(messages, landing, text="value")
    config = exchange_a("", "", duration="1 day")
    session = config.session(spark)
    return top_markets(stored_messages(session, landing), config)


# --- published results ------------------------------------------------------------


def sink_top5_day(spark: SparkSession, folder: str) -> DataFrame:
    """Published days, of whose markets most are cut away."""
    root = new_folder(spark, "published")
    publish_result(result_columns(top_n(event_days(spark, folder))), root, "first")
    return read_published(spark, root)


def sink_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The days published in two batches and then compacted."""
    root = new_folder(spark, "published")
    result = result_columns(top_n(event_days(spark, folder)))
    publish_result(result.where("row_num <= 2"), root, "first")
    publish_result(result.where("row_num > 2"), root, "second")
    compact_days(spark, root, "compacted")
    return read_published(spark, root)


def newest_window_day(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "published")
    result = result_columns(top_n(event_days(spark, folder)))
    publish_result(result, root, "first")
    return newest_window(spark, root, _last_day(result))



def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "published")
    publish_result(event_result(spark, folder), root, "first")
    return read_published(spark, root)


def sink_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that is written twice counts once."""
    root = new_folder(spark, "published")
    result = event_result(spark, folder)
    write_published(result, root, "first")
    write_published(result, root, "first")
    return read_published(spark, root)


def day_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "published")
    result = event_result(spark, folder)
    publish_result(result, root, "first")
    return read_day(spark, root, *_last_day(result))


def newest_window_rows(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "published")
    result = event_result(spark, folder)
    publish_result(result, root, "first")
    return newest_window(spark, root, _last_day(result))


def newest_file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The last day is published again, alone: its new file is the newest."""
    root = new_folder(spark, "published")
    result = event_result(spark, folder)
    publish_result(result, root, "first")
    day = _last_day(result)
    publish_result(read_day(spark, root, *day), root, "second")
    return newest_file(spark, root, day)


def success_markers(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "published")
    publish_result(event_result(spark, folder), root, "first")
    return marked_days(spark, root)


# --- streams ----------------------------------------------------------------------


def _stream_config(spark: SparkSession, duration: str) -> JobConfig:
    return exchange_a(
        new_folder(spark, "published"),
        new_folder(spark, "checkpoint"),
        zone="UTC",
        duration=duration,
        shuffle_partitions=spark.sparkContext.defaultParallelism,
    )


def stream_top5_day(spark: SparkSession, folder: str) -> DataFrame:
    """The continuous job over all events, in one run; the open day is not published."""
    config = _stream_config(spark, "1 day")
    session = config.session(spark)
    landing = new_folder(spark, "landing")
    publish_to_folder(event_quotes(session, folder), landing, POLLED.needed)
    run_available(landed_messages(session, landing), config)
    return read_published(spark, config.output)


def stream_top5_chained_day(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking as a stream of its own, into Spark's file sink."""
    config = _stream_config(spark, "1 day")
    session = config.session(spark)
    landing = new_folder(spark, "landing")
    publish_to_folder(event_quotes(session, folder), landing, POLLED.needed)
    start_chained(landed_messages(session, landing), config, ONCE).awaitTermination()
    return read_published(spark, config.output)


def stream_open_window_day(spark: SparkSession, folder: str) -> DataFrame:
    """What the job still holds of the window that it cannot publish yet."""
    config = _stream_config(spark, "1 day")
    session = config.session(spark)
    landing = new_folder(spark, "landing")
    publish_to_folder(event_quotes(session, folder), landing, POLLED.needed)
    run_available(landed_messages(session, landing), config)
    return open_groups(spark, config)


def stream_late_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Every fourth event lands, then the next fourth, and so on: what came too late."""
    config = _stream_config(spark, "1 day")
    session = config.session(spark)
    landing, gate, check = (new_folder(spark, name) for name in ("landing", "gate", "checkpoint"))
    quotes = event_quotes(session, folder)
    for fourth in range(4):
        publish_to_folder(quotes.where(F.col("event_id") % 4 == fourth), landing, POLLED.needed)
        start_gate(landed_messages(session, landing), config, gate, check, ONCE).awaitTermination()
    late = late_ticks(spark, config, gate)
    times = [wall_clock(F.col(c)).alias(c) for c in ("event_time", "window_end", "watermark")]
    return late.select("market", "name", "trade_price", "trade_volume", "micro_batch", *times)


def stream_from_latest_day(spark: SparkSession, folder: str) -> DataFrame:
    """The job is first started when half of the events have landed: only the others count."""
    config = _stream_config(spark, "1 day")
    session = config.session(spark)
    landing = new_folder(spark, "landing")
    quotes = event_quotes(session, folder)
    for half in range(2):
        publish_to_folder(quotes.where(F.col("event_id") % 2 == half), landing, POLLED.needed)
        run_available(landed_messages(session, landing, latest_for=config.checkpoint), config)
    return read_published(spark, config.output)


def stream_resumed_top5_minute(spark: SparkSession, folder: str) -> DataFrame:
    """The same job in minutes, stopped half-way and resumed from its checkpoint."""
    config = _stream_config(spark, "1 minute")
    session = config.session(spark)
    landing = new_folder(spark, "landing")
    quotes = event_quotes(session, folder)
    middle = table(session, folder, "events").select(
        F.floor((F.min(_millis("ts")) + F.max(_millis("ts"))) / 2).alias("middle")
    ).first().middle
    for half in (F.col("timestamp") < middle, F.col("timestamp") >= middle):
        publish_to_folder(quotes.where(half), landing, POLLED.needed)
        run_available(landed_messages(session, landing), config)
    return read_published(spark, config.output)


def stream_top5_day_seoul(spark: SparkSession, folder: str) -> DataFrame:
    """The continuous job in days of the Seoul clock."""
    config = replace(_stream_config(spark, "1 day"), zone=SEOUL)
    landing = new_folder(spark, "landing")
    publish_to_folder(event_quotes(spark, folder), landing, POLLED.needed)
    run_available(landed_messages(config.session(spark), landing), config)
    return read_published(spark, config.output)


def stream_pushed_top5_day(spark: SparkSession, folder: str) -> DataFrame:
    """The continuous job of the other exchange over frames that were named on the way."""
    config = replace(exchange_b("", ""), **vars(_stream_config(spark, "1 day")) | {
        "name": "exchange-b", "format": PUSHED,
    })
    session = config.session(spark)
    frames = encode_json(event_quotes(spark, folder).withColumnRenamed("market", "code"))
    names = _builders(spark, folder).select(_krw("market").alias("market"), "name")
    landing = new_folder(spark, "landing")
    publish_to_folder(pushed_messages(frames, names), landing, text="value")
    run_available(landed_messages(session, landing), config)
    return read_published(spark, config.output)


def stream_last_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of every user, kept up to date while every fourth event lands, then the
    next fourth, and so on."""
    events, session = stored_events(spark, folder), tick_session(spark, "UTC")
    landing, root, check = (new_folder(spark, name) for name in ("landing", "latest", "checkpoint"))
    for fourth in range(4):
        events.where(F.col("event_id") % 4 == fourth).write.mode("append").parquet(landing)
        stream = session.readStream.schema(events.schema).parquet(landing)
        start_latest(stream, "user_id", ["ts", "event_id"], root, check, ONCE).awaitTermination()
    return read_latest(spark, root, events.schema)


def stream_publish_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the messages by batch and half by a running query, into one folder."""
    quotes = event_quotes(spark, folder)
    first, landing = new_folder(spark, "landing"), new_folder(spark, "landing")
    odd = F.col("event_id") % 2 == 1
    publish_to_folder(quotes.where(odd), first, POLLED.needed)
    publish_to_folder(quotes.where(~odd), landing, POLLED.needed)
    stream_to_folder(
        landed_messages(spark, first), landing, new_folder(spark, "checkpoint"), trigger=ONCE, text="value"
    ).awaitTermination()
    return decode_json(stored_messages(spark, landing), TICKS_A, POLLED.needed)


QUERIES: dict[str, Query] = {
    "decode_events": decode_events,
    "decode_lenient": decode_lenient,
    "decode_accounting": decode_accounting,
    "undated_ticks": undated_ticks,
    "listing_rows": listing_rows,
    "first_quotes": first_quotes,
    "encode_roundtrip": encode_roundtrip,
    "publish_messages": publish_messages,
    "event_time": event_times,
    "tick_notional": tick_notional,
    "partition_keys": partition_keys,
    "prefix_filter": prefix_filter,
    "common_keys": common_keys,
    "common_keys_split": common_keys_split,
    "attach_name": attach_names,
    "attach_name_split": attach_names_split,
    "join_quotes": join_prices,
    "join_quotes_split": join_prices_split,
    "missing_quotes": missing_prices,
    "missing_quotes_split": missing_prices_split,
    "last_by_key": last_per_user,
    "notional_minute": notional_minute,
    "notional_day": notional_day,
    "notional_exact_day": notional_exact_day,
    "rank_all_day": rank_all_day,
    "top5_minute": top5_minute,
    "top5_day": top5_day,
    "top5_day_events": top5_day_events,
    "polled_top5_minute": polled_top5_minute,
    "pushed_top5_minute": pushed_top5_minute,
    "sink_roundtrip": sink_roundtrip,
    "sink_rewrite": sink_rewrite,
    "day_scan": day_scan,
    "newest_window": newest_window_rows,
    "newest_file": newest_file_rows,
    "success_markers": success_markers,
    "stream_top5_day": stream_top5_day,
    "stream_top5_chained_day": stream_top5_chained_day,
    "stream_open_window_day": stream_open_window_day,
    "stream_late_ticks": stream_late_ticks,
    "stream_from_latest_day": stream_from_latest_day,
    "stream_resumed_top5_minute": stream_resumed_top5_minute,
    "polled_unchanged": polled_unchanged,
    "pushed_unchanged": pushed_unchanged,
    "newest_listing": newest_listing,
    "polled_top5_day": polled_top5_day,
    "pushed_top5_day": pushed_top5_day,
    "top5_day_seoul": top5_day_seoul,
    "sink_top5_day": sink_top5_day,
    "sink_compacted": sink_compacted,
    "newest_window_day": newest_window_day,
    "stream_top5_day_seoul": stream_top5_day_seoul,
    "stream_pushed_top5_day": stream_pushed_top5_day,
    "stream_last_by_key": stream_last_by_key,
    "stream_publish_mixed": stream_publish_mixed,
}
