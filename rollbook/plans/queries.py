"""The registered queries: one operator each, over the stand-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions import scalars as fx
from rollbook.operators import extract, ingest, outcomes, replay, serve, sweep
from rollbook.operators.table_function import register_listing_rows
from rollbook.plans import standins as given
from rollbook.plans import stream_runs
from rollbook.plans.tables import harvested, listing_pool, stacked, text_ts
from rollbook.sources import frontier as site_frontier
from rollbook.session import settle
from rollbook.sources.sites import SITES, Layout

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Frontier


@query
def frontier_source(spark, sf_dir):
    """Each given page's site, and that site's first two pages of the foreign kinds."""
    site_frontier.register(spark)
    wanted = spark.read.format("frontier").load().where((F.col("page") <= 2) & F.col("kind").isin("wn", "wt", "3", "4"))
    names = F.array(*[F.lit(s.name) for s in SITES])
    pages = given.pages(spark, sf_dir).select("page_id", F.get(names, (F.col("page_id") % len(SITES)).cast("int")).alias("site"))
    return pages.join(wanted, "site").select("page_id", "site", "kind", "page", "url")


@query
def seed_frontier(spark, sf_dir):
    """Every page's host as a site with four kinds and one to three listing pages."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    kinds = F.array(*[
        F.struct(F.lit(a).alias("kind"), F.lit(b).alias("kinddesc")) for a, b in SITES[1].kinds
    ])
    sites = given.pages(spark, sf_dir).select(
        F.col("page_id").cast("string").alias("site"),
        host.alias("domain"),
        F.concat(F.lit("http://"), host, F.lit("/?stype=")).alias("url_head"),
        F.lit("&page=").alias("url_tail"),
        kinds.alias("kinds"),
        F.lit(1).alias("first_page"),
        (F.col("page_id") % 3 + 1).cast("int").alias("last_page"),
    )
    return site_frontier.seed_frontier(sites).drop("kind_no")


@query
def kind_lookup(spark, sf_dir):
    kind = (F.col("event_id") % 5 + 1).cast("string")
    found = given.events(spark, sf_dir).select("event_id", kind.alias("kind"))
    return site_frontier.with_kinddesc(found, SITES[1].kinds)


# Extraction over the given pages


def _nav(spark, sf_dir, layout: Layout) -> DataFrame:
    return extract.parse_cells(given.pages(spark, sf_dir), {"nav": layout}, F.lit("nav"))


@query
def page_rows(spark, sf_dir):
    rows = _nav(spark, sf_dir, given.NAV_ROWS).select(
        "page_id", F.posexplode("cells").alias("row_no", "c")
    )
    return rows.select("page_id", "row_no", F.col("c")[0].alias("text"))


@query
def lateral_rows(spark, sf_dir):
    """The same through the table function, with the layout given by name."""
    register_listing_rows(spark, {"nav": given.NAV_ROWS})
    return spark.sql(
        "SELECT page_id, row_no, cells[0] AS text FROM {pages}, LATERAL listing_rows(html, 'nav') WHERE error IS NULL",
        pages=given.pages(spark, sf_dir),
    )


@query
def page_attr(spark, sf_dir):
    rows = _nav(spark, sf_dir, given.NAV_LINKS).select("page_id", F.explode("cells").alias("c"))
    return rows.select("page_id", *[F.col("c")[i].alias(f"href{i}") for i in range(4)])


@query
def page_cells(spark, sf_dir):
    rows = _nav(spark, sf_dir, given.NAV_CELLS).select("page_id", F.explode("cells").alias("c"))
    return rows.select("page_id", *[F.col("c")[i].alias(f"c{i}") for i in range(6)])


@query
def page_atomic(spark, sf_dir):
    """Pages with fewer than six items lose all rows."""
    kept = _nav(spark, sf_dir, given.NAV_CELLS).where(F.col("error").isNull())
    rows = kept.select("page_id", F.explode("cells").alias("c"))
    items = rows.select("page_id", F.posexplode("c").alias("row_no", "text"))
    return items.where(F.col("row_no") >= 1)


@query
def page_profile(spark, sf_dir):
    parsed = _nav(spark, sf_dir, given.NAV_ROWS)
    return parsed.select("page_id", "n_chars", F.size("cells").alias("n_rows"))


# Extraction over listing pages in the sites' own layouts


def _items(spark, sf_dir) -> DataFrame:
    return extract.extract(given.listing_pages(spark, sf_dir), partitions=spark.sparkContext.defaultParallelism)


@query
def page_envelope(spark, sf_dir):
    return extract.unnest(_items(spark, sf_dir))


@query
def raw_page_rows(spark, sf_dir):
    return extract.unnest(extract.extract(given.response_pages(spark, sf_dir)))


@query
def raw_page_errors(spark, sf_dir):
    """Pages that are no text in the charset they declare."""
    items = extract.extract(given.response_pages(spark, sf_dir))
    undecodable = items.where(F.col("n_chars").isNull())
    return undecodable.select("url", F.regexp_extract("error", "^no (.*) text", 1).alias("charset"))


@query
def page_error_log(spark, sf_dir):
    return extract.error_log(_items(spark, sf_dir), F.lit("2024-02-01 03:04:05").cast("timestamp"))


@query
def listing_profile(spark, sf_dir):
    return extract.profile(_items(spark, sf_dir)).select("url", "status", "n_rows")


def _as_harvested(pool: DataFrame) -> DataFrame:
    return pool.withColumn("timestamp", text_ts(F.col("timestamp")))


@query
def harvest_pool(spark, sf_dir):
    rows = extract.unnest(settle(_items(spark, sf_dir), "items"))
    admitted = ingest.admit(rows, listing_pool(spark, sf_dir))
    row_id = F.concat_ws("-", "page_seq", "row_no")
    return _as_harvested(
        ingest.pool_rows(admitted, row_id, harvested()).drop("url", "page_seq", "row_no")
    )


@query
def harvest_accounting(spark, sf_dir):
    items = settle(_items(spark, sf_dir), "items")
    whole, _ = extract.split(items)
    return ingest.accounting(
        extract.unnest(items), listing_pool(spark, sf_dir), whole.select("url", "kinddesc", "page_seq")
    )


@query
def layout_union(spark, sf_dir):
    """Two layouts, the columns one lacks filled with ''."""
    wide = given.events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("ip"),
        F.col("event_type").alias("label"),
        F.date_format("ts", "yy-MM-dd HH:mm").alias("testtime"),
    )
    narrow = given.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("ip"),
        F.col("o_orderpriority").alias("label"),
        F.lit("").alias("testtime"),
    )
    return wide.unionByName(narrow).withColumn("portimage", F.lit(""))


# Scalars


@query
def classify_domestic(spark, sf_dir):
    label = given.label_of(F.col("event_type"))
    return given.events(spark, sf_dir).select("event_id", fx.classify(label).alias("anonymous"))


@query
def classify_foreign(spark, sf_dir):
    label = given.label_of(F.col("event_type"))
    kind = (F.col("event_id") % 4 + 1).cast("string")
    return given.events(spark, sf_dir).select(
        "event_id", fx.classify_foreign(label, kind).alias("anonymous")
    )


@query
def scheme_url(spark, sf_dir):
    http = F.upper(F.when(F.col("event_type") == "click", "http").otherwise("Https"))
    ip, port = F.col("user_id").cast("string"), (F.col("event_id") % 65536).cast("string")
    return given.events(spark, sf_dir).select(
        "event_id", http.alias("http"), fx.endpoint_url(http, ip, port).alias("url")
    )


@query
def strip_ws(spark, sf_dir):
    padded = F.concat(F.lit("\n　  \x1f"), F.col("text"), F.lit("\u0085\t 　\r\n"))
    return given.table(spark, sf_dir, "documents").select("doc_id", fx.strip_ws(padded).alias("text"))


@query
def ts_format(spark, sf_dir):
    return given.events(spark, sf_dir).select("event_id", fx.ts14(F.col("ts")).alias("ts14"))


# Ingest


@query
def admit_new(spark, sf_dir):
    found = given.sightings(spark, sf_dir)
    return ingest.admit(found, given.seed_pool(spark, sf_dir)).select("event_id", "ip", "port", "url")


@query
def existing_rows(spark, sf_dir):
    found = given.sightings(spark, sf_dir)
    return ingest.existing(found, given.seed_pool(spark, sf_dir)).select("event_id", "ip", "port", "url")


@query
def key_match_count(spark, sf_dir):
    return ingest.key_counts(given.pool(spark, sf_dir))


@query
def page_accounting(spark, sf_dir):
    found = given.sightings(spark, sf_dir)
    counted = ingest.accounting(found, given.seed_pool(spark, sf_dir), given.day_pages(found))
    return counted.drop("page_seq")


@query
def pool_rows(spark, sf_dir):
    admitted = ingest.admit(given.sightings(spark, sf_dir), given.seed_pool(spark, sf_dir))
    rows = ingest.pool_rows(admitted, F.col("event_id").cast("string"), harvested())
    return rows.select(
        "_id", "ip", "port", "anonymous", "http", "status",
        text_ts(F.col("timestamp")).alias("timestamp"), "rmrk",
    )


@query
def admit_big(spark, sf_dir):
    found = given.big_sightings(spark, sf_dir)
    pages = found.select("page_seq").distinct()
    return ingest.accounting(found, given.big_pool(spark, sf_dir), pages)


@query
def admit_big_rows(spark, sf_dir):
    return ingest.admit(given.big_sightings(spark, sf_dir), given.big_pool(spark, sf_dir))


# Sweep and dispatch


@query
def eligible_filter(spark, sf_dir):
    return ingest.scan_eligible(given.pool(spark, sf_dir)).select("_id", "anonymous", "status")


#: Probed before, of the swept classes, not over plain HTTP, of no kind that ends in "error".
NESTED = {
    "$and": [
        {"status": {"$gte": 1, "$lt": 4}},
        {"$or": [{"anonymous": "A"}, {"anonymous": {"$regex": "^W"}}, {"port": {"$in": ["8001", "8002", None]}}]},
        {"$nor": [{"http": "HTTP", "status": {"$gt": 2}}, {"record.ip": {"$exists": True}}]},
    ],
    "kinddesc": {"$not": {"$regex": "ERROR$", "$options": "i"}},
    "ip": {"$ne": "7"},
}


@query
def nested_filter(spark, sf_dir):
    return serve.find(given.pool(spark, sf_dir), NESTED).select("_id", "anonymous", "status", "http")


@query
def status_levels(spark, sf_dir):
    return sweep.status_levels(given.pool(spark, sf_dir))


@query
def status_sweep(spark, sf_dir):
    return sweep.sweep(given.pool(spark, sf_dir)).select("_id", "anonymous", "status")


@query
def dispatch_list(spark, sf_dir):
    return sweep.dispatch(sweep.sweep(given.pool(spark, sf_dir)))


@query
def dispatch_count(spark, sf_dir):
    return sweep.dispatch_count(sweep.sweep(given.pool(spark, sf_dir)))


@query
def probe_route(spark, sf_dir):
    return given.pool(spark, sf_dir).select("_id", fx.probe_route(F.col("anonymous")).alias("target"))


# Outcomes


@query
def outcome_classify(spark, sf_dir):
    return outcomes.classify_probes(given.probes(spark, sf_dir)).select("seq", "result")


@query
def outcome_split(spark, sf_dir):
    found = outcomes.classify_probes(given.probes(spark, sf_dir))
    counted = F.count(F.lit(1)).alias("n")
    return (
        outcomes.dead(found).select(F.lit("dead").alias("side"), "err_kind")
        .unionByName(outcomes.alive(found).select(F.lit("alive").alias("side"), "err_kind"))
        .groupBy("side", "err_kind")
        .agg(counted)
    )


@query
def outcome_join(spark, sf_dir):
    """Answers that name their record meet the dispatched rows."""
    answered = outcomes.classify_probes(given.probes(spark, sf_dir))
    joined = outcomes.attach_records(answered, given.pool(spark, sf_dir))
    return joined.select("seq", "result", "purl", "record.*")


@query
def outcome_unmatched(spark, sf_dir):
    """Answers about rows that were never dispatched."""
    answered = outcomes.classify_probes(given.probes(spark, sf_dir))
    sent = sweep.dispatch(given.pool(spark, sf_dir))
    return outcomes.unmatched(answered, sent).select("record_id", "seq", "result")


@query
def dead_pool_delete(spark, sf_dir):
    keys = outcomes.dead_keys(given.outcomes(spark, sf_dir))
    return outcomes.pool_without(given.pool(spark, sf_dir), keys)


@query
def dead_history_upsert(spark, sf_dir):
    return outcomes.history_after(given.history(spark, sf_dir), given.outcomes(spark, sf_dir))


@query
def dead_now_delete(spark, sf_dir):
    left = outcomes.now_without(given.now(spark, sf_dir), given.outcomes(spark, sf_dir))
    return left.withColumn("tm", text_ts(F.col("tm")))


@query
def alive_now_upsert(spark, sf_dir):
    merged = outcomes.upsert_now(given.now(spark, sf_dir), given.outcomes(spark, sf_dir))
    return merged.withColumn("tm", text_ts(F.col("tm")))


@query
def outcome_fold(spark, sf_dir):
    """The three tables after all outcomes."""
    return stacked(*outcomes.fold(
        given.pool(spark, sf_dir),
        given.now(spark, sf_dir),
        given.history(spark, sf_dir),
        given.outcomes(spark, sf_dir),
    ))


# Serving


def _live(spark, sf_dir) -> DataFrame:
    return outcomes.now_after(given.now(spark, sf_dir), given.outcomes(spark, sf_dir))


@query
def find_by_filter(spark, sf_dir):
    found = serve.find(_live(spark, sf_dir), {"anonymous": "WC"})
    return found.withColumn("tm", text_ts(F.col("tm")))


@query
def freshest_topk(spark, sf_dir):
    return serve.freshest(_live(spark, sf_dir), serve.TOP_N).withColumn("tm", text_ts(F.col("tm")))


def _requests(spark, sf_dir) -> DataFrame:
    return given.pages(spark, sf_dir).select("page_id")


@query
def random_assign(spark, sf_dir):
    draw = F.col("page_id") * 37 % (serve.MAX_DRAW + 1)
    return serve.assign(_requests(spark, sf_dir), _live(spark, sf_dir), draw)


@query
def random_assign_fixed(spark, sf_dir):
    """The list has 20 endpoints and the divisor is 30, so some draws assign none."""
    draw = F.col("page_id") * 37 % (serve.MAX_DRAW + 1)
    return serve.assign(
        _requests(spark, sf_dir), _live(spark, sf_dir), draw, n=20, modulus=serve.TOP_N
    )


# Membership


@query
def ledger_replay(spark, sf_dir):
    return replay.admissions(given.log(spark, sf_dir), ["ip"]).drop("dead")


@query
def ledger_members(spark, sf_dir):
    return replay.members(given.log(spark, sf_dir), ["ip"])


# Streams: the same tables landed in slices and read as streams


@query
def stream_harvest(spark, sf_dir):
    return stream_runs.harvest_counts(spark, sf_dir)


@query
def stream_harvest_pool(spark, sf_dir):
    return _as_harvested(stream_runs.harvest_pool(spark, sf_dir))


@query
def stream_readmission(spark, sf_dir):
    """Harvest, deaths, harvest again, with death stamps far off the harvest's clock."""
    return stream_runs.readmitted(spark, sf_dir)


@query
def stream_fold(spark, sf_dir):
    return stream_runs.fold_tables(spark, sf_dir)


@query
def stream_now(spark, sf_dir):
    return stream_runs.live_now(spark, sf_dir).withColumn("tm", text_ts(F.col("tm")))


@query
def stream_sweep(spark, sf_dir):
    return stream_runs.swept_twice(spark, sf_dir)


@query
def stream_ledger(spark, sf_dir):
    return stream_runs.ledger_admissions(spark, sf_dir)
