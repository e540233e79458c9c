import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import models
from listings import narrow_page, narrow_row, page, wide_page, wide_row
from rollbook.schemas import OUTCOME, PAGES
from rollbook.session import fresh_dir
from rollbook.streaming import fold, harvest, membership, tables
from rollbook.streaming import ledger as views
from rollbook.streaming.ledger import Ledger
from rollbook.streaming.sweep import sweep_cycle, sweep_stream
from test_outcomes import frames, random_case
from test_replay import frame, random_log

T0 = dt.datetime(2024, 1, 1)


def land(df, folder):
    df.write.mode("append").parquet(folder)


def stamp(minute):
    return F.lit(T0 + dt.timedelta(minutes=minute))


@pytest.fixture
def root(spark):
    return fresh_dir(spark, "stream")


def harvested(spark, root, minute, *pages):
    land(spark.createDataFrame(list(pages), PAGES), f"{root}/landed")
    harvest.harvest_stream(spark, f"{root}/landed", root, as_of=stamp(minute), pause=None).awaitTermination()


def dead_outcome(ip, port, minute, seq):
    record = ("x", ip, port, "A", 1, "HTTPS", "k")
    return (0, f"https://{ip}:{port}", record, T0 + dt.timedelta(minutes=minute), seq)


def keys(df):
    return sorted((r.ip, r.port) for r in df.collect())


def test_harvest_across_batches_and_readmission(spark, root):
    a, b, c = ("192.0.2.1", "80"), ("192.0.2.2", "80"), ("192.0.2.3", "80")
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row(*a), wide_row(*a))), page("xici", 2, "blocked"))
    harvested(
        spark, root, 1,
        page("cloud", 3, narrow_page(narrow_row(*a), narrow_row(*b))),
        page("cloud", 4, narrow_page(narrow_row(*b), narrow_row(*c))),
        page("xici", 5, wide_page()),
    )
    assert keys(ledger.pool()) == [a, a, b, c]
    detail = {r.url[-1]: (r.total, r.addcount, r.existcount) for r in ledger.crawdetail().collect()}
    assert detail == {"1": (2, 2, 0), "3": (1, 1, 1), "4": (1, 1, 1), "5": (0, 0, 0)}
    assert [r.url[-1] for r in ledger.crawlog().collect()] == ["2"]
    assert [r.timestamp for r in ledger.crawlog().collect()] == ["20240101000000"]

    land(spark.createDataFrame([dead_outcome(*a, 2, 1)], OUTCOME), f"{root}/outcomes")
    fold.fold_stream(spark, f"{root}/outcomes", root, pause=None).awaitTermination()
    assert keys(ledger.pool()) == [b, c]

    harvested(spark, root, 3, page("xici", 6, wide_page(wide_row(*a), wide_row(*b))))
    assert keys(ledger.pool()) == [a, b, c]
    sweep_cycle(spark, root, 0)
    assert keys(ledger.pool()) == [a, b, c]
    assert {r.status for r in ledger.pool().collect()} == {1}
    ids = [r._id for r in ledger.pool().collect()]
    assert len(set(ids)) == len(ids)


def test_a_repeated_harvest_batch_changes_nothing(spark, root):
    pages = spark.createDataFrame([page("xici", 1, wide_page(wide_row("192.0.2.1", "80")))], PAGES)
    for _ in range(2):
        harvest.harvest_batch(pages, 0, root, harvest.SITES, stamp(0))
    ledger = Ledger(spark, root)
    assert ledger.pool().count() == 1
    assert [(r.addcount, r.existcount) for r in ledger.crawdetail().collect()] == [(1, 0)]


@pytest.mark.parametrize("minute", [-5, 15])
def test_deaths_count_by_arrival_not_by_clock(spark, root, minute):
    """Deaths stamped behind and ahead of the harvest's clock."""
    a, b = ("192.0.2.1", "80"), ("192.0.2.2", "80")
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row(*a), wide_row(*b))))
    land(spark.createDataFrame([dead_outcome(*a, minute, 1)], OUTCOME), f"{root}/outcomes")
    fold.fold_stream(spark, f"{root}/outcomes", root, pause=None).awaitTermination()
    assert keys(ledger.pool()) == [b]
    for number in (2, 3):
        harvested(spark, root, number, page("xici", number, wide_page(wide_row(*a))))
    assert keys(ledger.pool()) == [a, b]
    detail = {r.url[-1]: r.addcount for r in ledger.crawdetail().collect()}
    assert detail == {"1": 2, "2": 1, "3": 0}


def test_a_repeated_death_keeps_its_round(spark, root):
    """A batch of outcomes that runs again after a later harvest removes no newer rows."""
    a, b = ("192.0.2.1", "80"), ("192.0.2.2", "80")
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row(*a), wide_row(*b))))
    out = spark.createDataFrame([dead_outcome(*a, 0, 0)], OUTCOME)
    fold.fold_batch(out, 0, root)
    harvested(spark, root, 1, page("xici", 2, wide_page(wide_row(*a))))
    for _ in range(2):
        assert keys(ledger.pool()) == [a, b]
        fold.fold_batch(out, 0, root)


def test_rounds_tell_what_the_accounts_tell(spark, root):
    a, b = ("192.0.2.1", "80"), ("192.0.2.2", "80")
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row(*a), wide_row(*b), wide_row(*b))), page("xici", 2, "blocked"))
    harvested(spark, root, 1, page("xici", 3, wide_page(wide_row(*a))))
    harvested(spark, root, 2, page("xici", 4, "blocked"))
    rounds = {r.batch: (r.pages, r.failures, r.items, r.added) for r in ledger.rounds().collect()}
    assert rounds == {0: (2, 1, 3, 3), 1: (1, 0, 1, 0), 2: (1, 1, 0, 0)}
    assert sum(r[3] for r in rounds.values()) == ledger.crawdetail().agg(F.sum("addcount")).first()[0]


def test_a_file_without_pages_is_a_round(spark, root):
    land(spark.createDataFrame([], PAGES), f"{root}/landed")
    harvest.harvest_stream(spark, f"{root}/landed", root, as_of=stamp(0), pause=None).awaitTermination()
    harvested(spark, root, 1, page("xici", 1, wide_page(wide_row("192.0.2.1", "80"))))
    ledger = Ledger(spark, root)
    assert keys(ledger.pool()) == [("192.0.2.1", "80")] and ledger.rounds().agg(F.sum("pages")).first()[0] == 1


def test_a_round_that_is_not_recorded_is_not_in_the_pool(spark, root):
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row("192.0.2.1", "80"))))
    half = spark.createDataFrame([("x", "192.0.2.9", "80", "A", 0)], "_id string, ip string, port string, anonymous string, status int")
    ledger.add(half, "pool", 1)
    assert keys(ledger.pool()) == [("192.0.2.1", "80")] and ledger.last_round() == 0


def test_lookups_read_slots_and_bits_of_the_batch(spark, root):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("ip"), F.lit("80").alias("port"))
    ledger = Ledger(spark, root)
    ledger.seed(rows, "pool")
    some = rows.where("ip IN ('17', '18')")
    lookup = ledger._read("pool", views.POOL, views.SLOT).where(views.near_keys(some)).select("ip", "port", "slot")
    text = lookup._jdf.queryExecution().executedPlan().toString()
    slots = {r[0] for r in views.slotted(some).select("slot").collect()}
    pruned = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "slot" in pruned and all(str(s) in pruned for s in slots) and "bit_get" in text and "Exchange" not in text
    assert len(set(lookup.inputFiles())) and {r.ip for r in lookup.collect()} >= {"17", "18"}
    assert lookup.count() < 20 and {r.slot for r in lookup.collect()} <= slots
    assert keys(ledger.known(some, before=0)) == [("17", "80"), ("18", "80")]
    assert keys(ledger.known(some, before=tables.SEED)) == []


def test_pages_that_share_a_number_fail(spark, root):
    a, b, c = ("192.0.2.1", "80"), ("192.0.2.2", "80"), ("192.0.2.3", "80")
    harvested(
        spark, root, 0,
        page("xici", 1, wide_page(wide_row(*a))), page("cloud", 1, narrow_page(narrow_row(*b))),
        page("xici", None, wide_page(wide_row(*b))), page("xici", 2, wide_page(wide_row(*c))),
    )
    ledger = Ledger(spark, root)
    assert keys(ledger.pool()) == [c]
    assert sorted(r.records.split(", ")[1] for r in ledger.crawlog().collect()) == ["no page number", *["page number shared by 2 pages"] * 2]
    assert [(r.addcount, r.existcount) for r in ledger.crawdetail().collect()] == [(1, 0)]


def test_a_page_that_breaks_the_parser_fails_alone(spark, root):
    huge = "&#" + "9" * 5000 + ";"
    harvested(
        spark, root, 0,
        page("xici", 1, wide_page(wide_row("192.0.2.1", "80", address=huge))),
        page("xici", 2, wide_page(wide_row("192.0.2.2", "80", speed=huge))),
        page("xici", 3, wide_page(wide_row("192.0.2.3", "80"))),
    )
    ledger = Ledger(spark, root)
    assert keys(ledger.pool()) == [("192.0.2.3", "80")]
    assert sorted(r.url[-1] for r in ledger.crawlog().collect()) == ["1", "2"]


def test_a_lost_checkpoint_is_refused(spark, root):
    land(spark.createDataFrame([page("xici", 1, wide_page(wide_row("192.0.2.1", "80")))], PAGES), f"{root}/landed")
    harvest.harvest_batch(spark.read.schema(PAGES).parquet(f"{root}/landed"), 0, root, harvest.SITES, stamp(0))
    with pytest.raises(RuntimeError, match="checkpoint"):
        harvest.harvest_stream(spark, f"{root}/landed", root, pause=None)


def test_streams_with_state_need_their_checkpoints(spark, root):
    log = frame(spark, random_log(2, 10))
    land(log, f"{root}/events")
    membership.ledger_stream(spark, f"{root}/events", root, log.schema, ["ip", "port"]).awaitTermination()
    land(spark.createDataFrame([dead_outcome("192.0.2.1", "80", 2, 1)], OUTCOME), f"{root}/outcomes")
    fold.now_stream(spark, f"{root}/outcomes", root, pause=None).awaitTermination()
    Path(root, "_ledger").rename(f"{root}/_lost")
    with pytest.raises(RuntimeError, match="checkpoint"):
        membership.ledger_stream(spark, f"{root}/events", root, log.schema, ["ip", "port"])
    Path(root, "_now").rename(f"{root}/_lost_too")
    with pytest.raises(RuntimeError, match="checkpoint"):
        fold.now_stream(spark, f"{root}/outcomes", root, pause=None)


def test_a_clock_sweeps(spark, root):
    ledger = Ledger(spark, root)
    harvested(spark, root, 0, page("xici", 1, wide_page(wide_row("192.0.2.1", "80"))))
    query = sweep_stream(spark, root, pause="1 second")
    for _ in range(120):
        if Path(root, "dispatch", "batch=2").exists():
            break
        time.sleep(0.5)
    query.stop()
    assert [(r.sweep, r.status) for r in ledger.dispatched().where("sweep < 2").orderBy("sweep").collect()] == [(0, 1), (1, 2)]
    assert ledger.pool().first().status >= 2


def test_fold_stream_equals_one_by_one(spark, root):
    pool, now, history, results = random_case(5, 60)
    _, now_df, history_df, out = frames(spark, pool, now, history, results)
    ledger = Ledger(spark, root)
    ledger.seed(now_df.withColumns({"result": F.lit(1), "seq": F.lit(None).cast("bigint")}), "now")
    ledger.seed(history_df, "history")
    for low, high in ((0, 20), (20, 21), (21, 60)):
        land(out.where(F.col("seq").between(low, high - 1)), f"{root}/outcomes")
        fold.fold_stream(spark, f"{root}/outcomes", root, pause=None).awaitTermination()
        live = fold.now_stream(spark, f"{root}/outcomes", root, pause=None)
        live.awaitTermination()
    _, want_now, want_history = models.fold(pool, now, history, results)
    assert {r.url: (r.tm, r.anonymous) for r in ledger.now().collect()} == want_now
    assert {r._id: r.status for r in ledger.history().collect()} == want_history
    # The state has a row a URL, however many outcomes there were.
    urls = out.select("purl").distinct().count()
    assert live.lastProgress["stateOperators"][0]["numRowsTotal"] == urls < 60


@pytest.mark.parametrize("width", [7, 1 << 20])
def test_ledger_stream_equals_one_by_one(spark, root, width):
    log = random_log(3, 90)
    df = frame(spark, log)
    admitted, members = models.replay(log)
    names = ["ip", "port"]
    for low, high in ((0, 30), (30, 31), (31, 70), (70, 90)):
        land(df.where(F.col("seq").between(low, high - 1)), f"{root}/landed")
        query = membership.ledger_stream(spark, f"{root}/landed", root, df.schema, names, width=width)
        query.awaitTermination()
    got = membership.read_admissions(spark, root, df.schema)
    assert sorted(r.seq for r in got.collect()) == admitted
    found = membership.read_members(spark, root, names).collect()
    assert {(r.ip, r.port) for r in found} == members
    seq = {k: i for i, (k, _) in enumerate(log)}
    assert all(r.seq == seq[r.ip, r.port] for r in found)
    # The state has a value a key; the tables written before are not read.
    states = [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert max(states) <= len(seq)
    plan = query._jsq.explainInternal(False)
    assert "admissions" not in plan.split("FileScan", 1)[-1]


def test_a_bounded_backlog_gives_the_same_tables(spark, root):
    log = random_log(6, 60)
    df = frame(spark, log)
    admitted, _ = models.replay(log)
    for low in (0, 20, 40):
        land(df.where(F.col("seq").between(low, low + 19)).coalesce(1), f"{root}/landed")
    membership.ledger_stream(
        spark, f"{root}/landed", root, df.schema, ["ip", "port"], files_per_batch=1
    ).awaitTermination()
    got = membership.read_admissions(spark, root, df.schema)
    assert sorted(r.seq for r in got.collect()) == admitted
    assert len(list(Path(root, "_ledger", "commits").glob("[0-9]*"))) == 3


def test_a_lost_ledger_commit_changes_nothing(spark, root):
    """The last batch runs again if its commit is lost: state and sink have it once."""
    log = random_log(4, 40)
    df = frame(spark, log)
    admitted, members = models.replay(log)
    for low in (0, 20):
        land(df.where(F.col("seq").between(low, low + 19)), f"{root}/landed")
        membership.ledger_stream(spark, f"{root}/landed", root, df.schema, ["ip", "port"]).awaitTermination()
    for lost in Path(root, "_ledger", "commits").glob("*1*"):
        lost.unlink()
    membership.ledger_stream(spark, f"{root}/landed", root, df.schema, ["ip", "port"]).awaitTermination()
    assert sorted(r.seq for r in membership.read_admissions(spark, root, df.schema).collect()) == admitted
    assert {(r.ip, r.port) for r in membership.read_members(spark, root, ["ip", "port"]).collect()} == members


def test_sweeps_between_harvests_and_deaths(spark, root):
    a, b, c = ("192.0.2.1", "80"), ("192.0.2.2", "80"), ("192.0.2.3", "80")
    ledger = Ledger(spark, root)

    def sent(number):
        rows = ledger.dispatched().where(F.col("sweep") == number).collect()
        return sorted((r.ip, r.status) for r in rows)

    harvested(
        spark, root, 0,
        page("xici", 1, wide_page(wide_row(*a), wide_row(*b), wide_row("192.0.2.9", "80", label="透明"))),
    )
    for number in (0, 1, 1):
        sweep_cycle(spark, root, number)
    assert (sent(0), sent(1)) == ([(a[0], 1), (b[0], 1)], [(a[0], 2), (b[0], 2)])
    harvested(spark, root, 1, page("xici", 2, wide_page(wide_row(*b), wide_row(*c))))
    land(spark.createDataFrame([dead_outcome(*a, 2, 1)], OUTCOME), f"{root}/outcomes")
    fold.fold_stream(spark, f"{root}/outcomes", root, pause=None).awaitTermination()
    sweep_cycle(spark, root, 2)
    assert sent(2) == [(b[0], 3), (c[0], 1)]
    status = {r.ip: r.status for r in ledger.pool().collect()}
    assert status == {b[0]: 3, c[0]: 1, "192.0.2.9": 0}
