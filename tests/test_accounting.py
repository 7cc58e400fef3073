"""What the decoder leaves out, counted in the same pass."""

from __future__ import annotations

import pytest

import tickflow.jobs.job as job
from helpers import land, rows, table_of, tick
from tickflow.config import exchange_a
from tickflow.functions.accounting import Account, unreadable
from tickflow.plans.queries import QUERIES, decode_accounting
from tickflow.plans.ticks import backfill, decode_ticks, tick_accounts, top_markets
from tickflow.schemas import POLLED
from tickflow.session import RECENT_UPDATES
from tickflow.sources.published import read_published
from tickflow.sources.ticks import landed_messages

FAULTY = [
    tick("KRW-A", 1), tick("KRW-B", "1.5"), tick("KRW-C", "n/a"), tick("KRW-D", None),
    {**tick("KRW-E", 1), "timestamp": 2**63 - 1}, {**tick("KRW-F", 1), "timestamp": "soon"},
    {**tick("KRW-G", "x", volume="y"), "timestamp": None}, {"market": "KRW-H"},
    "not json", '{"market": "KRW', "[]", "null", "", "   ", '"text"',
]
WANT = {
    "messages": 15, "decoded": 8, "skipped": 7, "undated": 4,
    unreadable("trade_price"): 2, unreadable("trade_volume"): 1, unreadable("timestamp"): 1,
}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_counts_of_a_table(seoul):
    account = Account("a", time="timestamp")
    ticks = decode_ticks(table_of(seoul, FAULTY), POLLED, account=account)
    assert ticks.count() == 8
    assert account.counts() == WANT


def test_rows_are_the_same_with_and_without(seoul):
    messages = table_of(seoul, FAULTY)
    assert rows(decode_ticks(messages, POLLED, account=Account("b"))) == rows(decode_ticks(messages, POLLED))


def test_counts_are_whole_when_the_result_is_cut(seoul):
    """The rank drops rows, the counts are of all."""
    config = exchange_a("", "", top=1)
    messages = table_of(seoul, FAULTY * 50).repartition(7)
    accounts = tick_accounts(messages, config)
    assert top_markets(messages, config, accounts).count() == 1
    assert accounts[0].counts() == {name: 50 * n for name, n in WANT.items()}


def test_no_messages(seoul):
    account = Account("c", time="timestamp")
    decode_ticks(table_of(seoul, ["x"]).where("false"), POLLED, account=account).collect()
    assert account.counts() == dict.fromkeys(WANT, 0)


def test_one_scan_one_parse_and_no_further_shuffle(seoul, tmp_path):
    folder = str(tmp_path / "land")
    land(folder, 0, FAULTY)
    messages, config = seoul.read.text(folder), exchange_a("", "")
    counted = plan(top_markets(messages, config, tick_accounts(messages, config)))
    plain = plan(top_markets(messages, config))
    assert counted.count("FileScan") == plain.count("FileScan") == 1
    assert counted.count("from_json(") == plain.count("from_json(") == 1
    assert counted.count("Exchange") == plain.count("Exchange")
    assert "CollectMetrics" in counted and "Python" not in counted


def test_the_query_reads_its_table_once(spark, tables, monkeypatch):
    scans = []
    read = spark.read.parquet

    def counting(path):
        scans.append(path)
        return read(path)

    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path: counting(path))
    assert decode_accounting(spark, tables).count() == 7
    assert len(scans) == 1 and QUERIES["decode_accounting"] is decode_accounting


def test_backfill_tells_its_counts(seoul, tmp_path):
    config = exchange_a(str(tmp_path / "out"), "")
    assert backfill(table_of(seoul, FAULTY), config, "one") == WANT
    assert read_published(seoul, config.output).count() == 4


@pytest.mark.parametrize("apart", [False, True])
def test_counts_of_a_stream(seoul, tmp_path, apart):
    """By micro-batch, and summed over the query's life although Spark forgets."""
    config = exchange_a(str(tmp_path / "out"), str(tmp_path / "check"), shuffle_partitions=2)
    folder = str(tmp_path / "land")
    for number in range(5):
        land(f"{folder}/a", number, FAULTY[number * 3 : number * 3 + 3])
        land(f"{folder}/b", number, [])
    streams = [landed_messages(seoul, f"{folder}/{name}", max_files=1) for name in "ab"]
    seoul.conf.set(RECENT_UPDATES, "3")
    try:
        query = job.run_available(streams if apart else streams[0], config)
    finally:
        seoul.conf.unset(RECENT_UPDATES)
    assert job.decoded_counts(query) == WANT
    assert job.decoded_counts(query) == WANT  # looking twice adds nothing
    account = Account(f"{config.name}-0", time="timestamp")
    of_last = [account.of_progress(p) for p in query.recentProgress if p["numInputRows"]][-1]
    assert of_last["messages"] == 3 and of_last["skipped"] == 3
