"""Load of cleaned reviews into a star schema: repeatable, append-only, published as a whole.

A load writes each table's new rows into a folder of its own, ``<root>/<table>/load_id=<n>``, and
appends its run rows last. Readers only see loads that have a successful run, so a load that
stops half-way is invisible, and nothing is renamed or overwritten. One load or compaction runs at
a time.

Many small loads make many small folders. ``compact`` copies what can be seen into one folder per
table and publishes them by a snapshot, one write that holds all run rows until then: readers take
the newest snapshot and the loads after it. Older folders stay as they are for those who still read
them, until ``drop_superseded`` removes them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.functions.columns import (
    fill_count,
    is_blank,
    or_default,
    platform_name,
    to_int_trunc,
    to_number,
    to_review_date,
    username,
)
from reviewloom.operators.describe import star_distribution
from reviewloom.operators.order_stats import dense_number, first_per_key, least
from reviewloom.operators.tables import COMPRESSION, literal_rows, stored
from reviewloom.schemas import RUN_STATES, SENTIMENTS, STAR_RULE, WAREHOUSE
from reviewloom.sources.readers import POSITION, combine_sources

REASONS = ["no_id", "no_text", "bad_star"]
# columns kept beside the review rows so that labels and counts come from what was written
EXTRA = "_given_sentiment string, _source int, load_id long"


# --- row level -----------------------------------------------------------------------------


def reject_reason(star: Column) -> Column:
    """First rule a row breaks, null for a valid row. A rating that fits no int is out of range;
    a missing one is fine."""
    whole = to_int_trunc(star)
    return (
        F.when(is_blank("review_id"), REASONS[0])
        .when(is_blank("review"), REASONS[1])
        .when(star.isNotNull() & ~F.coalesce(whole.between(1, 5), F.lit(False)), REASONS[2])
    )


def validate(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reject_reason", reject_reason(to_number("star_rating")))


def normalise_row(rows: DataFrame) -> DataFrame:
    """Typed and trimmed rows; the review text itself stays as given."""
    keep = [c for c in rows.columns
            if c in (*POSITION, "platform_key", "reject_reason", "_hash")]
    return rows.select(
        or_default("review_id", "").alias("review_id"),
        or_default("app_name", "").alias("app_name"),
        username("user").alias("username"),
        to_int_trunc(to_number("star_rating")).alias("star_rating"),
        to_review_date("date").alias("review_date"),
        F.col("review").alias("review_text"),
        fill_count("review_length").alias("review_length"),
        fill_count("word_count").alias("word_count"),
        or_default("title", None).alias("title"),
        or_default("sentiment", "unrated").alias("sentiment"),
        *keep,
    )


# --- keys ----------------------------------------------------------------------------------


def upsert_dim(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """New rows ``(id, keys...)`` of a dimension, numbered by first appearance after the highest
    id in use. Incoming rows collapse per key before anything is joined."""
    first = incoming.groupBy(*keys).agg(least(order).alias("_at"))
    new = first.join(existing.select(*keys), list(keys), "left_anti")
    return assign_ids(existing, new, ["_at"]).select("id", *keys)


def assign_ids(existing: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``id``: gap-free numbers in input order after the highest existing id."""
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    return dense_number(new, order, "id", start=top + F.lit(1))


def new_ids(page: DataFrame, seen: DataFrame, key: str = "review_id") -> DataFrame:
    """Distinct ids of a page that have not been seen."""
    return page.select(key).distinct().join(seen.select(key), key, "left_anti")


def insert_new(
    existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key is neither stored nor earlier in the input."""
    return first_per_key(incoming, [key], order, taken=existing)


def numbered_position(rows: DataFrame) -> DataFrame:
    """Adds ``_pos``, the input position as one number: rows of earlier files, in the order of
    sources and file names, come first. ``_row`` is below 2^63 and differs between the rows of a
    source. A number of fixed width can be hash-aggregated, unlike a file's name."""
    files = rows.select("_source", "_file").distinct()  # one row per file
    number = F.row_number().over(W.orderBy("_source", "_file"))
    files = files.select("_source", "_file", number.cast("decimal(19,0)").alias("_no"))
    scale = F.lit(1 << 62).cast("decimal(19,0)") * F.lit(2).cast("decimal(1,0)")
    return rows.join(files, ["_source", "_file"]).withColumn(
        "_pos", (F.col("_no") * scale + F.col("_row")).cast("decimal(38,0)")).drop("_no")


def resolve_fk(facts: DataFrame, apps: DataFrame, users: DataFrame, platforms: DataFrame):
    """Natural keys to surrogate keys. Platforms are two rows; how apps and users are joined, and
    whether a frequent one is split, is decided at run time from measured sizes."""
    p = platforms.select(F.col("id").alias("platform_fk"), "platform_key")
    a = apps.select(F.col("id").alias("app_fk"), "app_name", "platform_fk")
    u = users.select(F.col("id").alias("user_fk"), "username", "platform_fk")
    facts = facts.join(F.broadcast(p), "platform_key")
    return facts.join(a, ["app_name", "platform_fk"]).join(u, ["username", "platform_fk"])


def insert_labels(existing: DataFrame, reviews: DataFrame, sentiment: str, at: Column):
    """Labels of newly inserted reviews; values outside the allowed ones give no label. The ids of
    new reviews are new, so no label that is there can be of one of them."""
    allowed = reviews.filter(F.col(sentiment).isin(SENTIMENTS)).select(
        F.col("id").alias("review_fk"), F.col(sentiment).alias("sentiment")
    )
    return assign_ids(existing, allowed, ["review_fk"]).select(
        "id", "review_fk", "sentiment", F.lit(STAR_RULE).alias("label_method"),
        at.alias("labelled_at"),
    )


# --- outcome -------------------------------------------------------------------------------


def load_outcome(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows_in_file = rows_inserted + rows_skipped + rows_rejected`` for a load that is not
    (yet) written, with the number of rows per reason. One pass, combined per id map-side."""
    flagged = validate(rows).select(
        F.col("reject_reason").alias("reason"), or_default("review_id", "").alias("review_id")
    )
    per_id = flagged.groupBy(
        "reason", F.when(F.col("reason").isNull(), F.col("review_id")).alias("review_id")
    ).agg(F.count(F.lit(1)).alias("n"))
    valid_ids = per_id.filter(F.col("reason").isNull()).select("review_id")
    present = existing.select("review_id").join(valid_ids, "review_id", "left_semi")
    stored = present.agg(F.count(F.lit(1)).alias("c")).scalar()
    ok = F.col("reason").isNull()
    total = F.coalesce(F.sum("n"), F.lit(0))
    rejected = F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0))
    return per_id.agg(
        total.alias("rows_in_file"),
        F.count_if(ok).alias("ids"),
        rejected.alias("rows_rejected"),
        *[F.coalesce(F.sum(F.when(F.col("reason") == r, F.col("n"))), F.lit(0)).alias(f"r{i}")
          for i, r in enumerate(REASONS)],
    ).select(
        "rows_in_file",
        (F.col("ids") - stored).alias("rows_inserted"),
        (F.col("rows_in_file") - F.col("rows_rejected") - F.col("ids") + stored)
        .alias("rows_skipped"),
        "rows_rejected",
        F.col("r0").alias("empty_id"),
        F.col("r1").alias("empty_text"),
        F.col("r2").alias("bad_star"),
    )


def dry_run(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """What a load would do. ``rows_valid`` counts duplicates, as nothing has been looked up for
    it; the projected duplicates stand beside it."""
    out = load_outcome(existing, rows)
    return out.select(
        "rows_in_file",
        (F.col("rows_in_file") - F.col("rows_rejected")).alias("rows_valid"),
        "rows_rejected",
        F.col("rows_skipped").alias("projected_duplicates"),
    )


# --- storage -------------------------------------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


SNAPSHOTS = "_snapshots"


def _listed(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Sub-folders of a folder and the names in each."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [(f.getPath().getName(), [x.getPath().getName() for x in fs.listStatus(f.getPath())])
            for f in fs.listStatus(p) if f.isDirectory()]


def _snapshot(spark: SparkSession, root: str) -> int:
    """Load id of the newest published snapshot, 0 for none. A job that writes moves its files in
    when it commits, so a folder without any was not published."""
    return max((int(name.split("=")[1]) for name, files in _listed(spark, f"{root}/{SNAPSHOTS}")
                if any(f.startswith("part-") for f in files)), default=0)


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a table since the newest snapshot and in it, of unfinished loads too. The folder
    column prunes what came before."""
    schema = WAREHOUSE[table]
    if table == "reviews":
        schema = f"{schema}, {EXTRA}"
    else:
        schema = f"{schema}, load_id long"
    since = _snapshot(spark, root)
    path = f"{root}/{table}"
    if path_exists(spark, path):
        rows = spark.read.schema(schema).parquet(path)
    else:
        fields = [c.split() for c in schema.split(", ")]
        rows = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in fields])
    if not since:
        return rows
    if table == "ingestion_runs":  # the snapshot itself holds the older ones
        older = spark.read.schema(schema).parquet(f"{root}/{SNAPSHOTS}")
        return rows.filter(F.col("load_id") > since).unionByName(
            older.filter(F.col("load_id") == since))
    return rows.filter(F.col("load_id") >= since)


def _finished(spark: SparkSession, root: str) -> DataFrame:
    runs = _stored(spark, root, "ingestion_runs")
    return runs.filter(F.col("status") == "success").select("load_id").distinct()


def _of_loads(rows: DataFrame, loads: DataFrame, current: int | None = None) -> DataFrame:
    """Rows of the finished loads and of the current one. ``load_id`` is a folder column, so the
    loads that the join knows prune the scan when it runs."""
    if current is not None:
        this = loads.sparkSession.range(current, current + 1).select(F.col("id").alias("load_id"))
        loads = loads.unionByName(this).distinct()
    return rows.join(loads, "load_id", "left_semi")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of successful loads."""
    cols = [c.split()[0] for c in WAREHOUSE[table].split(", ")]
    rows = _stored(spark, root, table)
    if table != "ingestion_runs":
        rows = _of_loads(rows, _finished(spark, root))
    return rows.select(*cols)


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    loads = _finished(spark, root)
    return {
        t: (_stored(spark, root, t) if t == "ingestion_runs"
            else _of_loads(_stored(spark, root, t), loads))
        .select(*[c.split()[0] for c in cols.split(", ")])
        for t, cols in WAREHOUSE.items()
    }


def _write(df: DataFrame, root: str, table: str, load_id: int) -> str:
    path = f"{root}/{table}/load_id={load_id}"
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return path


def ingest(
    spark: SparkSession,
    sources: Sequence[tuple[str, str]],
    root: str,
    run_at: dt.datetime | None = None,
    **read_options,
) -> DataFrame:
    """Load ``[(path, platform), ...]`` and return the run rows, one per source."""
    rows = combine_sources(spark, sources, **read_options)
    return ingest_rows(spark, rows, root, [s[0] for s in sources], [s[1] for s in sources],
                       run_at)


def ingest_rows(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    names: Sequence[str],
    platforms: Sequence[str],
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """Load rows that carry ``platform_key`` and an input position; see ``ingest``.

    The input is parsed once into a staging table. Keys, ids and positions are worked out on narrow
    rows of it and end in a stored mapping from position to ids, which the texts then join once.
    Every step reads what an earlier one has written, so a lost executor cannot make two steps see
    different rows. ``_row`` is below 2^63 and differs between the rows of a source.
    """
    root = root.rstrip("/")
    stamp = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    at = F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    load_id = _next_load(spark, root)
    try:
        return _load(spark, rows, root, names, platforms, at, load_id)
    except Exception:
        _drop(spark, _staging(root, load_id))
        _record(spark, root, load_id, at, names, platforms, {}, {}, "failed")
        raise


def _staging(root: str, load_id: int) -> str:
    return f"{root}/_staging/load_id={load_id}"


def _next_load(spark: SparkSession, root: str) -> int:
    top = _stored(spark, root, "ingestion_runs").agg(F.max("id"), F.max("load_id")).first()
    load_id = max(top[0] or 0, top[1] or 0) + 1
    # step over folders of a load whose driver died before it could record anything
    while any(path_exists(spark, f"{root}/{t}/load_id={load_id}") for t in ("_staging", "platforms")):
        load_id += 1
    return load_id


def _load(spark, rows, root, names, platforms, at, load_id) -> DataFrame:
    staging = _staging(root, load_id)
    row_hash = F.xxhash64(*[c for c in rows.columns if c not in POSITION])
    checked = validate(rows.withColumn("_hash", row_hash))
    normalise_row(checked).write.mode("errorifexists").option(
        "compression", COMPRESSION).parquet(staging)
    staged = spark.read.parquet(staging)

    per_source = {
        r["_source"]: r
        for r in staged.groupBy("_source").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
            F.bit_xor("_hash").alias("xor"),
            F.sum(F.col("_hash").cast("decimal(38,0)")).alias("sum"),
        ).collect()  # one row per source given
    }
    valid = staged.filter(F.col("reject_reason").isNull())

    loads = _finished(spark, root)

    def visible(table: str) -> DataFrame:
        """What earlier loads and this one have written so far."""
        return _of_loads(_stored(spark, root, table), loads, load_id)

    # ids, keys and positions are worked out without the texts
    narrow = stored(numbered_position(valid.select(
        "review_id", "app_name", "username", "platform_key", *POSITION)), "keys")

    # the platforms are given; apps and users come from all valid rows, duplicates included
    given = literal_rows(spark, list(enumerate(platforms)), ["_at", "platform_key"])
    new_platforms = upsert_dim(visible("platforms"), given, ["platform_key"], ["_at"])
    _write(new_platforms.withColumn("display_name", platform_name("platform_key")).coalesce(1),
           root, "platforms", load_id)
    all_platforms = visible("platforms")
    p = all_platforms.select(F.col("id").alias("platform_fk"), "platform_key")
    keyed = narrow.join(F.broadcast(p), "platform_key")
    for table, name in (("apps", "app_name"), ("users", "username")):
        keys = [name, "platform_fk"]
        new = upsert_dim(visible(table), keyed.select(*keys, "_pos"), keys, ["_pos"])
        _write(new, root, table, load_id)

    before = visible("reviews")
    fresh = insert_new(before, narrow.drop("_file"), "review_id", ["_pos"])
    facts = resolve_fk(fresh, visible("apps"), visible("users"), all_platforms)
    mapped = stored(assign_ids(before, facts.select(
        "_source", "_row", "_pos", "app_fk", "user_fk", "platform_fk"), ["_pos"]), "mapping")
    # here the texts come in
    out = valid.join(mapped.drop("_pos"), ["_source", "_row"]).withColumns({
        "ingestion_run": (F.lit(load_id) + F.col("_source")).cast("long"),
        "_given_sentiment": F.col("sentiment"),
    })
    cols = [c.split()[0] for c in f"{WAREHOUSE['reviews']}, {EXTRA}".split(", ")]
    # dates next to each other give the row groups narrow date ranges to prune by
    _write(out.select(*[c for c in cols if c != "load_id"]).sortWithinPartitions("review_date"),
           root, "reviews", load_id)

    written = _stored(spark, root, "reviews").filter(F.col("load_id") == load_id)
    labels = insert_labels(visible("sentiment_labels"), written, "_given_sentiment", at)
    _write(labels, root, "sentiment_labels", load_id)

    inserted = {
        r["_source"]: r
        for r in written.groupBy("_source").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("_given_sentiment").isin(SENTIMENTS)).alias("unlabelled"),
        ).collect()  # one row per source given
    }
    runs = _record(spark, root, load_id, at, names, platforms, per_source, inserted, "success")
    _drop(spark, staging)
    return runs


def loaded_before(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a load of this source name has been published."""
    runs = _stored(spark, root.rstrip("/"), "ingestion_runs")
    return not runs.filter((F.col("source_file") == name) & (F.col("status") == "success")).isEmpty()


def _drop(spark, path) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _record(spark, root, load_id, at, names, platforms, counts, inserted, status) -> DataFrame:
    """Appends the run rows: this is what publishes a load."""
    if status not in RUN_STATES:
        raise ValueError(status)
    data = []
    for i, (name, platform) in enumerate(zip(names, platforms)):
        c, done = counts.get(i), inserted.get(i)
        n, bad = (c["n"], c["rejected"]) if c else (0, 0)
        new = done["n"] if done else 0
        checksum = f"{n}-{c['xor']}-{c['sum']}" if c else "-"
        data.append((load_id + i, str(name), checksum, platform, n, new, n - bad - new, bad,
                     done["unlabelled"] if done else 0, status))
    fields = [c.split() for c in WAREHOUSE["ingestion_runs"].split(", ")]
    names = [c for c, _ in fields if c != "run_at"]
    runs = literal_rows(spark, data, names).withColumn("run_at", at)
    runs = runs.select(*[F.col(c).cast(t).alias(c) for c, t in fields])
    if status == "failed" and path_exists(spark, f"{root}/ingestion_runs/load_id={load_id}"):
        return runs
    path = _write(runs.coalesce(1), root, "ingestion_runs", load_id)
    return spark.read.schema(WAREHOUSE["ingestion_runs"]).parquet(path)


def compact(spark: SparkSession, root: str) -> int:
    """Puts what can be seen now into one folder per table; the load id of the snapshot, or 0 if
    there is no load yet.

    Nothing is shuffled: small files are packed into tasks and each task writes one. The snapshot
    is written last. If the job stops before, its folders belong to no load and are never seen.
    """
    root = root.rstrip("/")
    runs = _stored(spark, root, "ingestion_runs")
    if runs.isEmpty():
        return 0
    load_id = _next_load(spark, root)
    loads = _finished(spark, root)
    for table in WAREHOUSE:
        if table == "ingestion_runs":
            continue
        rows = _of_loads(_stored(spark, root, table), loads).drop("load_id")
        if table == "reviews":
            rows = rows.sortWithinPartitions("review_date")
        _write(rows, root, table, load_id)
    _write(runs.drop("load_id").coalesce(1), root, SNAPSHOTS, load_id)
    return load_id


def drop_superseded(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders that came before the newest snapshot, and the staging of loads that were
    cut off; their paths. Who still reads them fails, so run it when older readers are done."""
    root = root.rstrip("/")
    since = _snapshot(spark, root)
    gone = []
    for table in (*WAREHOUSE, SNAPSHOTS, "_staging"):
        for name, _ in _listed(spark, f"{root}/{table}"):
            if int(name.split("=")[1]) < since:
                gone.append(f"{root}/{table}/{name}")
                _drop(spark, gone[-1])
    return sorted(gone)


# --- queries on the warehouse ---------------------------------------------------------------


def analysis_base(wh: Mapping[str, DataFrame]) -> DataFrame:
    """Reviews with label and user name; reviews without a label fall out."""
    labels = wh["sentiment_labels"].select(F.col("review_fk").alias("id"), "sentiment")
    users = wh["users"].select(F.col("id").alias("user_fk"), "username")
    base = wh["reviews"].select(
        "id", "review_id", "user_fk", "star_rating", "review_date", "review_text",
        "review_length", "word_count",
    ).join(labels, "id")
    return base.join(users, "user_fk").drop("user_fk", "id")


def load_labelled(
    wh: Mapping[str, DataFrame],
    platform: str | None = None,
    app: str | None = None,
    label_method: str | None = None,
) -> DataFrame:
    """Dated, labelled reviews with app and platform, optionally of one platform, app or
    labelling method. Filters on the dimensions reduce them before the join."""
    labels = wh["sentiment_labels"].select(
        F.col("review_fk").alias("id"), "sentiment", "label_method"
    )
    if label_method:
        labels = labels.filter(F.col("label_method") == label_method)
    platforms = wh["platforms"].select(F.col("id").alias("platform_fk"), "platform_key")
    if platform:
        platforms = platforms.filter(F.col("platform_key") == platform)
    apps = wh["apps"].select(F.col("id").alias("app_fk"), "app_name")
    if app:
        apps = apps.filter(F.col("app_name") == app)
    reviews = wh["reviews"].filter(F.col("review_date").isNotNull()).select(
        "id", "review_id", "app_fk", "platform_fk", "star_rating", "review_date", "review_text",
        "review_length", "word_count", "title",
    )
    out = reviews.join(F.broadcast(platforms), "platform_fk")
    return out.join(apps, "app_fk").join(labels, "id").select(
        "id", "review_id", "app_name", "platform_key", "star_rating", "review_date",
        "review_text", "review_length", "word_count", "title", "sentiment", "label_method",
    )


def _of_platform(wh: Mapping[str, DataFrame], platform: str) -> DataFrame:
    p = wh["platforms"].filter(F.col("platform_key") == platform)
    p = p.select(F.col("id").alias("platform_fk"))
    return wh["reviews"].join(F.broadcast(p), "platform_fk")


def platform_sentiment(wh: Mapping[str, DataFrame], platform: str) -> DataFrame:
    labels = wh["sentiment_labels"].select(F.col("review_fk").alias("id"), "sentiment")
    return _of_platform(wh, platform).select("id").join(labels, "id").groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("n")
    )


def platform_stars(wh: Mapping[str, DataFrame], platform: str) -> DataFrame:
    return star_distribution(_of_platform(wh, platform)).select("star_rating", "n")


def top_apps(wh: Mapping[str, DataFrame], platform: str, n: int = 10) -> DataFrame:
    """Apps with most reviews. Reviews are counted per key first, so the join sees one row per
    app."""
    counts = _of_platform(wh, platform).groupBy("app_fk").agg(F.count(F.lit(1)).alias("k"))
    named = counts.join(wh["apps"].select(F.col("id").alias("app_fk"), "app_name"), "app_fk")
    return (
        named.groupBy("app_name").agg(F.sum("k").alias("n"))
        .orderBy(F.desc("n"), F.asc("app_name")).limit(n)
    )


def warehouse_totals(wh: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for table in ("reviews", "apps", "users", "sentiment_labels"):
        one = wh[table].agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("metric"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def health(wh: Mapping[str, DataFrame], platform: str) -> DataFrame:
    """All post-load numbers as ``(section, item, n)``."""
    def section(name, df, item):
        return df.select(F.lit(name).alias("section"), F.col(item).cast("string").alias("item"),
                         F.col("n").cast("long").alias("n"))

    return (
        section("totals", warehouse_totals(wh), "metric")
        .unionByName(section("sentiment", platform_sentiment(wh, platform), "sentiment"))
        .unionByName(section("stars", platform_stars(wh, platform), "star_rating"))
        .unionByName(section("top_apps", top_apps(wh, platform), "app_name"))
    )


# Constraints of the star schema: keys, references and rules for the audits.
UNIQUE_KEYS = {
    "platforms": ["platform_key"],
    "apps": ["app_name", "platform_fk"],
    "users": ["username", "platform_fk"],
    "reviews": ["review_id"],
    "sentiment_labels": ["review_fk"],
}
FOREIGN_KEYS = [
    ("apps", "platform_fk", "platforms"),
    ("users", "platform_fk", "platforms"),
    ("reviews", "app_fk", "apps"),
    ("reviews", "user_fk", "users"),
    ("reviews", "platform_fk", "platforms"),
    ("reviews", "ingestion_run", "ingestion_runs"),
    ("sentiment_labels", "review_fk", "reviews"),
]


def check_rules() -> dict[str, dict[str, Column]]:
    def present(c):
        return F.col(c).isNotNull()

    return {
        "reviews": {
            "star_rating in 1..5": F.col("star_rating").between(1, 5),
            "review_id present": present("review_id"),
            "review_text present": present("review_text"),
            "review_length present": present("review_length"),
            "word_count present": present("word_count"),
        },
        "sentiment_labels": {
            "sentiment allowed": F.col("sentiment").isin(SENTIMENTS),
            "sentiment present": present("sentiment"),
            "label_method present": present("label_method"),
        },
        "ingestion_runs": {"status allowed": F.col("status").isin(RUN_STATES)},
    }
