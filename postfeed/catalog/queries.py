"""Every operator as a query over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.catalog.views import BRAND, INSTRUCTION, RUN_TS, table, view, view_stream
from postfeed.functions import markup, text
from postfeed.functions.keys import feed_key, usable_key
from postfeed.functions.requests import client_ip, cors_headers, is_private_ip, parse_user_agent
from postfeed.operators import dedup, keypass, numbering, posting, reports, requests, rewrite, rowdigest, sync, winners
from postfeed.operators import progress as progress_ops
from postfeed.plans import jobs
from postfeed.schema import PUBLISHED, REVISION_COLUMNS, revision_columns
from postfeed.session import materialise, scratch_path, spread
from postfeed.sources import feed, feedread, tables
from postfeed.sources.keyindex import KeyIndex
from postfeed.sources.versions import VersionedTable
from postfeed.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__.removesuffix("_")] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _run_ts():
    return F.lit(RUN_TS.isoformat(sep=" ")).cast("timestamp_ntz")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, sf_dir, "staging"), view(spark, sf_dir, "published")


# ---- scans, keys, schema ----


@_query
def published_keys(spark, sf_dir):
    return tables.read_keys(view(spark, sf_dir, "published"))


@_query
def usable_keys(spark, sf_dir):
    return view(spark, sf_dir, "published").select("id", usable_key().alias("usable_key"))


@_query
def feed_key_(spark, sf_dir):
    return view(spark, sf_dir, "published").select("id", feed_key().alias("feed_key"))


@_query
def sample_rows(spark, sf_dir):
    rows = posting.sample_rows(view(spark, sf_dir, "staging"))
    return rows.select("id", "position", "job_description", "company", "partner_job_id")


@_query
def available_postings(spark, sf_dir):
    return posting.available(view(spark, sf_dir, "published")).select("id", "partner_job_id", "position")


@_query
def schema_conform(spark, sf_dir):
    published = view(spark, sf_dir, "published")
    # Each order priority stands for the revision its rows were written under.
    snapshots = [
        published.where(F.col("position").startswith(f"{revision}-")).select(revision_columns(revision))
        for revision in REVISION_COLUMNS
    ]
    return posting.conform_all(snapshots)


@_query
def schema_violations(spark, sf_dir):
    return posting.schema_violations(view(spark, sf_dir, "staging"))


@_query
def staging_mapped(spark, sf_dir):
    return posting.staging_to_published(view(spark, sf_dir, "staging"))


@_query
def load_timestamps(spark, sf_dir):
    rows = view(spark, sf_dir, "staging").select("id", "created_at", "updated_at")
    return posting.default_timestamps(rows, _run_ts())


@_query
def assigned_ids(spark, sf_dir):
    return numbering.assign_ids(view(spark, sf_dir, "staging"), start=1_000_000)


@_query
def batches(spark, sf_dir):
    return numbering.batch_no(view(spark, sf_dir, "staging"), size=20)


@_query
def batch_outcomes(spark, sf_dir):
    return numbering.batch_outcomes(view(spark, sf_dir, "staging"), posting.sink_accepts(), size=20)


# ---- sync ----


@_query
def new_postings(spark, sf_dir):
    return sync.new_postings(*_sides(spark, sf_dir)).select("id", "partner_job_id", "position", "job_description")


@_query
def already_published(spark, sf_dir):
    return sync.already_published(*_sides(spark, sf_dir)).select("id", "partner_job_id")


@_query
def expired_postings(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return sync.expired_postings(published, staging).select("id", "partner_job_id")


@_query
def expired_report(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return sync.expired_report(sync.expired_postings(published, staging))


@_query
def expired_examples(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return sync.expired_details(sync.expired_postings(published, staging))


@_query
def published_after_expiry(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    gone = sync.expired_postings(published.select("id", "partner_job_id"), staging)
    return sync.delete_rows(published, gone).select("id", "partner_job_id", "description")


@_query
def missing_keys(spark, sf_dir):
    return sync.missing_keys(*_sides(spark, sf_dir))


@_query
def missing_examples(spark, sf_dir):
    return sync.missing_examples(sync.missing_keys(*_sides(spark, sf_dir)))


@_query
def published_flag(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return sync.published_flag(staging.select("id", "partner_job_id"), published)


@_query
def reconcile(spark, sf_dir):
    return sync.reconcile(*_sides(spark, sf_dir))


@_query
def sync_counts(spark, sf_dir):
    return sync.sync_counts(*_sides(spark, sf_dir))


@_query
def run_summary(spark, sf_dir):
    return sync.run_summary(*_sides(spark, sf_dir))


@_query
def progress(spark, sf_dir):
    return sync.progress(*_sides(spark, sf_dir))


@_query
def progress_delta(spark, sf_dir):
    return progress_ops.progress_delta(view(spark, sf_dir, "samples"))


@_query
def loaded_new(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return rewrite.load_new(staging, published, _run_ts(), rewrite.next_id(published))


@_query
def rejected_new(spark, sf_dir):
    rows = rewrite.rejected_new(*_sides(spark, sf_dir))
    return rows.select("id", F.array_join("reasons", "; ").alias("reasons"))


@_query
def sync_result(spark, sf_dir):
    staging, published = _sides(spark, sf_dir)
    return rewrite.sync(staging, published, _run_ts(), rewrite.next_id(published))


@_query
def sync_actions(spark, sf_dir):
    return keypass.row_actions(*_sides(spark, sf_dir))


@_query
def indexed_keys(spark, sf_dir):
    """Which staging keys are published, by an index of the published ones in two parts and many buckets."""
    staging, published = _sides(spark, sf_dir)
    index = KeyIndex(spark, scratch_path(spark, "key-index"))
    for part, odd in (("even", 0), ("odd", 1)):
        index.add(published.where(F.col("id") % 2 == odd).select("partner_job_id"), part, bucket_keys=500)
    return index.known(tables.read_keys(staging))


# ---- versions of a table ----


def _versioned(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The published rows as the first version of a table, in files by range of id."""
    made = VersionedTable(spark, scratch_path(spark, "versioned"), PUBLISHED)
    made.append(view(spark, sf_dir, "published").repartitionByRange(16, "id"), "load")
    return made


@_query
def versioned_sync(spark, sf_dir):
    """Expired rows go and new ones come in one version; the run is repeated, which changes nothing."""
    made = _versioned(spark, sf_dir)
    for _ in range(2):
        jobs.sync_table(made, view(spark, sf_dir, "staging"), RUN_TS, "sync")
    return made.read()


@_query
def versioned_dedup(spark, sf_dir):
    made = _versioned(spark, sf_dir)
    jobs.dedup_table(made, "dedup")
    return made.read().select("id", "partner_job_id", "position", "description")


@_query
def version_history(spark, sf_dir):
    """Rows of every version: loaded, without those of one range of ids, without duplicates, loaded anew."""
    made = _versioned(spark, sf_dir)
    ids = made.read().select("id")
    bounds = F.broadcast(ids.agg(F.max("id").alias("last")))
    # Only files of that range are written again.
    made.delete(ids.join(bounds, F.col("id") * 4 > F.col("last") * 3).select("id"), "range")
    made.delete(dedup.duplicates_to_remove(made.read()), "duplicates")
    made.replace(made.read(1), "anew")
    return made.history().select("version", "commit", "rows")


@_query
def snapshot_differences(spark, sf_dir):
    """Rows that a faulty copy of the published table has changed, lost or repeated, found by digests."""
    intended = view(spark, sf_dir, "published")
    text_off = F.when(F.col("id") % 487 == 0, F.concat(F.coalesce("description", F.lit("")), F.lit("."))).otherwise(F.col("description"))
    faulty = intended.where("id % 499 <> 0").withColumn("description", text_off)
    faulty = materialise(faulty.unionByName(faulty.where("id % 509 = 0")), "faulty")
    buckets = rowdigest.differing_buckets(rowdigest.digests(intended), rowdigest.digests(faulty))
    return rowdigest.differing_rows(intended, faulty, buckets)


# ---- deduplication ----


def _deltas(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = view(spark, sf_dir, "published").select("id", "partner_job_id", "updated_at", "created_at")
    return [rows.where(F.col("id") % 3 == i) for i in (1, 0, 2)]


@_query
def incremental_latest(spark, sf_dir):
    """The latest row per key and the rows it had, from three deltas."""
    states = [winners.winner_state(delta) for delta in _deltas(spark, sf_dir)]
    return winners.merge_states(*states).select("partner_job_id", winners.winner_id().alias("id"), "n")


@_query
def incremental_removed(spark, sf_dir):
    """The rows that each of three deltas makes superfluous, and in which."""
    state, gone = None, []
    for number, delta in enumerate(_deltas(spark, sf_dir)):
        own = winners.winner_state(delta)
        before = own.limit(0) if state is None else state
        state = materialise(winners.merge_states(before, own), "winners")
        gone.append(winners.superseded(before, delta, state).withColumn("delta", F.lit(number)))
    return gone[0].unionByName(gone[1]).unionByName(gone[2])


@_query
def keep_latest(spark, sf_dir):
    rows = dedup.keep_latest(view(spark, sf_dir, "published"))
    return rows.select("id", "partner_job_id", "position", "description")


@_query
def duplicates_to_remove(spark, sf_dir):
    return dedup.duplicates_to_remove(view(spark, sf_dir, "published")).select("id", "partner_job_id")


@_query
def duplicate_examples(spark, sf_dir):
    rows = sync.examples(dedup.duplicates_to_remove(view(spark, sf_dir, "published")))
    return rows.select("id", "partner_job_id", F.col("updated_at").cast("string").alias("updated_at"))


@_query
def duplicate_groups(spark, sf_dir):
    return dedup.duplicate_groups(view(spark, sf_dir, "published"))


@_query
def dedup_counts(spark, sf_dir):
    return dedup.dedup_counts(view(spark, sf_dir, "published"))


# ---- feed ----


@_query
def feed_build_date(spark, sf_dir):
    return feed.feed_build_date(view(spark, sf_dir, "doc_postings"), RUN_TS)


@_query
def feed_rows(spark, sf_dir):
    return feed.feed_rows(view(spark, sf_dir, "doc_postings"))


@_query
def feed_lines(spark, sf_dir):
    return feed.feed_lines(view(spark, sf_dir, "doc_postings"), RUN_TS)


@_query
def feed_round_trip(spark, sf_dir):
    path = scratch_path(spark, "feed")
    feed.write_feed(view(spark, sf_dir, "doc_postings"), path, RUN_TS, ordered=True)
    return feed.read_feed(spark, path)


@_query
def feed_order(spark, sf_dir):
    """The ids in the written document, one after the other."""
    path = scratch_path(spark, "feed")
    feed.write_feed(view(spark, sf_dir, "doc_postings"), path, RUN_TS)
    places = feed.feed_order(spark, path, r"<applyUrl><!\[CDATA\[[^\]]*b=([0-9]+)\]")
    return places.select("place", F.col("found").cast("long").alias("id"))


@_query
def feed_document(spark, sf_dir):
    """All jobs of a feed of which some are broken: those are set aside and only their key is shown."""
    path = scratch_path(spark, "feed")
    xml = F.when(F.col("id") % 37 == 0, F.replace("xml", F.lit("</title>"), F.lit("</tile>"))).otherwise(F.col("xml"))
    feed.feed_rows(view(spark, sf_dir, "doc_postings")).select(xml).write.text(path)
    read, aside = feedread.read_document(spark, path)
    key = F.regexp_extract("text", r"<partnerJobId><!\[CDATA\[([^\]]*)\]", 1)
    broken = aside.select(key.alias("partnerJobId"), F.lit(True).alias("malformed"))
    return read.withColumn("malformed", F.lit(False)).unionByName(broken, allowMissingColumns=True)


@_query
def feed_refreshed(spark, sf_dir):
    """The feed after a run over postings of which some were others, lacked or were too many before."""
    # A refresh scans its postings three times, so their texts are joined once and not before every scan.
    path, rows = scratch_path(spark, "feed"), materialise(view(spark, sf_dir, "doc_postings"), "postings", compression="zstd")
    former = rows.where("id % 90 <> 5").withColumn("position", F.when(F.col("id") < 50, F.lit("old")).otherwise(F.col("position")))
    more = rows.where("id < 30").withColumn("id", F.col("id") + 1_000_000_000)
    for postings in (former.unionByName(more), rows):
        feed.refresh_feed(postings, path, RUN_TS, range_ids=100)
    return feedread.read_document(spark, f"{path}/1-jobs")[0]


@_query
def utf8_repair(spark, sf_dir):
    # Whole texts as bytes, each followed by bytes that are not valid there.
    broken = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("FF80"))).when(
        F.col("doc_id") % 3 == 1, F.unhex(F.lit("E282"))
    )
    raw = F.concat(F.encode("text", "UTF-8"), F.coalesce(broken, F.unhex(F.lit(""))))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_utf8(raw).alias("text"))


@_query
def cdata_escape(spark, sf_dir):
    return view(spark, sf_dir, "doc_postings").select("id", text.escape_cdata("description").alias("description"))


@_query
def rfc_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.rfc_date("ts").alias("rfc_date"))


# ---- posting texts ----


def _page_column(spark: SparkSession, sf_dir: str, function, name: str = "html") -> DataFrame:
    return view(spark, sf_dir, "page_postings").select("id", function("html").alias(name))


@_query
def allow_tags(spark, sf_dir):
    return _page_column(spark, sf_dir, markup.allow_tags)


@_query
def map_tags(spark, sf_dir):
    return _page_column(spark, sf_dir, markup.map_tags)


@_query
def balanced_tags(spark, sf_dir):
    """Texts whose tags were filtered, before and after they are closed in order."""
    allowed = _page_column(spark, sf_dir, markup.allow_tags)
    return allowed.select("id", markup.balance_tags("html").alias("html"), markup.tags_balanced("html").alias("was_balanced"))


@_query
def remove_links(spark, sf_dir):
    return _page_column(spark, sf_dir, markup.remove_links)


@_query
def paragraph_breaks(spark, sf_dir):
    return _page_column(spark, sf_dir, markup.paragraph_breaks)


@_query
def end_labels(spark, sf_dir):
    return _page_column(spark, sf_dir, markup.end_labels)


@_query
def strip_text(spark, sf_dir):
    return view(spark, sf_dir, "staging").select("id", text.strip("job_description").alias("stripped"))


@_query
def label_counts(spark, sf_dir):
    return reports.label_counts(view(spark, sf_dir, "page_postings"), "html")


@_query
def posting_parts(spark, sf_dir):
    parts = _page_column(spark, sf_dir, markup.posting_parts, "parts")
    return parts.select(
        "id",
        *[f"parts.{name}" for name in ("company", "summary", "closing_company", "places", "body")],
        F.array_join("parts.labels", " ").alias("labels"),
    )


@_query
def intro_wrap(spark, sf_dir):
    wrapped = markup.intro_wrap("company", F.concat(F.lit("Per "), F.col("company")), F.col("url"), "html", BRAND)
    return view(spark, sf_dir, "page_postings").select("id", wrapped.alias("html"))


@_query
def rewrite_default(spark, sf_dir):
    pages = view(spark, sf_dir, "page_postings").select("id", "html")
    return rewrite.rewrite_text(pages, column="html")


@_query
def rewrite_requests(spark, sf_dir):
    request = rewrite.rewrite_request("html", INSTRUCTION)
    return view(spark, sf_dir, "page_postings").select("id", request.alias("request"))


@_query
def rewrite_plugged(spark, sf_dir):
    """A plugged-in rewriter that fails on some texts: those stay as they are."""

    def factory():
        def improve(original: str) -> str:
            if "[#J-ONE]" in original:
                raise ValueError("not today")
            return f"  <p>{len(original)}</p>{original}\n"

        return improve

    pages = view(spark, sf_dir, "page_postings").select("id", "html")
    return rewrite.rewrite_text(pages, factory, column="html", workers=4)


@_query
def text_preview(spark, sf_dir):
    return rewrite.preview_pairs(view(spark, sf_dir, "staging"))


@_query
def text_truncated(spark, sf_dir):
    return view(spark, sf_dir, "doc_postings").select("id", text.truncate_text("description").alias("description"))


def _conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = view(spark, sf_dir, "page_postings").select("id", "html")
    # Texts that hold a REMOTE label are left as they are and show which rules raw pages break.
    formatted = markup.format_posting(pages.withColumn("improved", F.col("html")), "improved")
    new = F.when(F.col("html").contains("[#J-REMOTE]"), F.col("html")).otherwise(F.col("improved"))
    return reports.conformance_rows(formatted.withColumn("improved", new), "html", "improved")


@_query
def conformance(spark, sf_dir):
    return _conformance(spark, sf_dir)


@_query
def conformance_report(spark, sf_dir):
    return reports.conformance_report(_conformance(spark, sf_dir))


# ---- request log ----


@_query
def client_ip_(spark, sf_dir):
    ip = client_ip("x_forwarded_for", "x_real_ip", "peer_ip")
    return view(spark, sf_dir, "requests").select("event_id", ip.alias("client_ip"))


@_query
def private_ip_(spark, sf_dir):
    ip = client_ip("x_forwarded_for", "x_real_ip", "peer_ip")
    return view(spark, sf_dir, "requests").select("event_id", is_private_ip(ip).alias("is_private"))


@_query
def user_agents(spark, sf_dir):
    parsed = view(spark, sf_dir, "requests").select("event_id", parse_user_agent("user_agent").alias("ua"))
    return parsed.select(
        "event_id",
        "ua.original",
        "ua.name",
        "ua.version",
        F.col("ua.os.name").alias("os"),
        F.col("ua.device.name").alias("device"),
    )


@_query
def cors_headers_(spark, sf_dir):
    headers = view(spark, sf_dir, "requests").select("event_id", cors_headers("response_headers").alias("headers"))
    return headers.select("event_id", "headers.*")


def _flat_geo(geo: str) -> list:
    names = ["region_iso_code", "continent_name", "city_name", "country_iso_code", "country_name", "region_name"]
    place = [F.col(f"{geo}.location.lon").alias("lon"), F.col(f"{geo}.location.lat").alias("lat")]
    return [F.col(f"{geo}.{name}").alias(name) for name in names] + place


@_query
def log_geo(spark, sf_dir):
    ip = client_ip("x_forwarded_for", "x_real_ip", "peer_ip")
    log = view(spark, sf_dir, "requests").select("event_id", ip.alias("client_ip"))
    located = requests.geo_enrich(log, view(spark, sf_dir, "geo_dim"))
    return located.select("event_id", "client_ip", F.col("geo").isNotNull().alias("has_geo"), *_flat_geo("geo"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_records(view(spark, sf_dir, "requests"), view(spark, sf_dir, "geo_dim"))


@_query
def log_payload(spark, sf_dir):
    req, res, dest = "record.request", "record.response", "record.destination"
    return _records(spark, sf_dir).select(
        "event_id",
        "time",
        *[F.col(f"{req}.{name}") for name in ("authorization", "method", "origin")],
        *[F.col(f"{req}.url.{name}").alias(f"url_{name}") for name in ("path", "original", "scheme", "domain")],
        F.col(f"{req}.user_agent.name").alias("ua_name"),
        F.col(f"{res}.status_code"),
        F.col(f"{res}.time").alias("duration_ms"),
        F.col(f"{res}.access_control_allow_origin"),
        F.col(f"{dest}.ip").alias("ip"),
        *_flat_geo(f"{dest}.geo"),
    )


@_query
def access_log_json(spark, sf_dir):
    return requests.log_lines(_records(spark, sf_dir))


# ---- streams: the table files arrive as micro-batches, the output is read back ----


@_query
def stream_new_postings(spark, sf_dir):
    run_dir = scratch_path(spark, "sync-stream")
    arriving = view_stream(spark, sf_dir, "staging", "orders", "o_orderkey")
    published = view(spark, sf_dir, "published").select("id", "partner_job_id")
    streams.stream_sync(arriving, published, run_dir, RUN_TS, prepare=spread).awaitTermination()
    return streams.read_stream_postings(spark, run_dir).drop("batch_id")


@_query
def stream_access_log(spark, sf_dir):
    run_dir = scratch_path(spark, "log-stream")
    arriving = view_stream(spark, sf_dir, "requests", "events", "event_id")
    streams.stream_access_log(arriving, view(spark, sf_dir, "geo_dim"), run_dir, prepare=spread).awaitTermination()
    return streams.read_access_log(spark, run_dir)


@_query
def stream_progress(spark, sf_dir):
    run_dir = scratch_path(spark, "progress-stream")
    staging, published = _sides(spark, sf_dir)
    ticks = view_stream(spark, sf_dir, "staging", "orders", "o_orderkey").select("id")
    query = streams.stream_progress(
        ticks, lambda: staging, lambda: published, run_dir, "run-1", trigger={"availableNow": True}
    )
    query.awaitTermination()
    return streams.read_progress(spark, run_dir).drop("sampled_at")


@_query
def stream_latest(spark, sf_dir):
    run_dir = scratch_path(spark, "latest-stream")
    streams.stream_latest(view_stream(spark, sf_dir, "published", "orders", "o_orderkey"), run_dir).awaitTermination()
    return streams.read_stream_latest(spark, run_dir)


@_query
def log_compacted(spark, sf_dir):
    run_dir = scratch_path(spark, "log-table")
    log = VersionedTable(spark, f"{run_dir}/log", streams.LOG_TABLE)
    arriving = view_stream(spark, sf_dir, "requests", "events", "event_id")
    streams.stream_log_table(arriving, view(spark, sf_dir, "geo_dim"), log, run_dir, "requests", 100_000, compact_every=3).awaitTermination()
    return log.read().select("line")
