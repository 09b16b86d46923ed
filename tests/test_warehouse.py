import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewloom.operators.audit import fingerprint, portable_fingerprint
from reviewloom.plans import warehouse as W
from reviewloom.sources.readers import combine_sources, read_clean_reviews, read_raw_reviews
from reviewloom.sources.writers import write_reviews
from reviewloom.streaming import streams as S
from reviewloom.streaming.streams import dedupe_stream, ingest_stream, write_stream

D = "2024-01-05"
CLEAN = [
    ("b1", "ann", "5", D, "fine \"app\"\nwith, breaks", "positive", "Nice"),
    ("", "bob", "5", D, "text", "positive", ""),
    ("b3", "bob", "5", D, "", "positive", ""),
    ("b4", "bob", "6", D, "text", "positive", ""),
    ("b5", "bob", "0.5", D, "text", "negative", ""),
    ("b6", "bob", "4.7", D, "NA", "positive", ""),
    ("b7", "", "x", D, " text ", "", ""),
    ("b1", "cat", "1", D, "again", "negative", ""),
    ("b9", "ann", "3", D, "text", "mixed", ""),
    ("b10", "ann", "2", "03/04/2024", "text", "negative", ""),
    (" ", "dan", "5", D, "text", "positive", ""),
    ("b12", "dan", "inf", D, "text", "positive", ""),
]
SCHEMA = ("review_id string, user string, star_rating string, date string, review string, "
          "sentiment string, title string")


@pytest.fixture()
def csv(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.createDataFrame(CLEAN, SCHEMA).withColumn("app_name", F.lit("App")).withColumn(
        "review_length", F.length("review").cast("string"))
    write_reviews(df.coalesce(1), path, "csv")
    return path


def test_csv_keeps_text(spark, csv):
    df = read_clean_reviews(spark, csv, "apple")
    got = {r["review_id"]: r for r in df.collect()}
    assert df.count() == 12
    assert got["b1"]["review"] in ("fine \"app\"\nwith, breaks", "again")
    assert got["b6"]["review"] == "NA" and got["b7"]["review"] == " text "
    assert got["b3"]["review"] == "" and got["b4"]["word_count"] == ""


def test_load_and_reload(spark, csv, tmp_path):
    root = str(tmp_path / "db")
    run = W.ingest(spark, [(csv, "googleplay")], root).first()
    assert (run["rows_in_file"], run["rows_inserted"], run["rows_skipped"],
            run["rows_rejected"], run["rows_unlabelled"]) == (12, 5, 1, 6, 1)
    wh = W.read_warehouse(spark, root)
    assert rows(wh["users"].select("username")) == [("ann",), ("anonymous",), ("bob",), ("cat",)]
    stored = {r["review_id"]: r for r in wh["reviews"].collect()}
    assert set(stored) == {"b1", "b6", "b7", "b9", "b10"}
    assert stored["b6"]["star_rating"] == 4 and stored["b7"]["star_rating"] is None
    assert stored["b10"]["review_date"] is None and stored["b7"]["title"] is None
    assert stored["b1"]["title"] == "Nice" and stored["b7"]["review_text"] == " text "
    assert wh["sentiment_labels"].count() == 4
    assert [r["id"] for r in wh["reviews"].orderBy("id").collect()] == [1, 2, 3, 4, 5]

    again = W.ingest(spark, [(csv, "googleplay")], root).first()
    assert (again["rows_inserted"], again["rows_skipped"], again["rows_rejected"]) == (0, 6, 6)
    assert again["source_checksum"] == run["source_checksum"] and again["id"] == 2
    assert W.read_table(spark, root, "users").count() == 4

    # the same names on another platform are other users, but a review id is unique over all
    other = W.ingest(spark, [(csv, "apple")], root).first()
    assert other["rows_inserted"] == 0
    assert W.read_table(spark, root, "users").count() == 8


def test_failed_load_is_invisible(spark, csv, tmp_path, monkeypatch):
    root = str(tmp_path / "db")

    def broken(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(W, "insert_labels", broken)
        with pytest.raises(RuntimeError):
            W.ingest(spark, [(csv, "apple")], root)
    wh = W.read_warehouse(spark, root)
    assert wh["reviews"].count() == 0
    assert [r["status"] for r in wh["ingestion_runs"].collect()] == ["failed"]
    run = W.ingest(spark, [(csv, "apple")], root).first()
    assert run["rows_inserted"] == 5 and W.read_table(spark, root, "reviews").count() == 5


def test_two_sources_in_one_load(spark, csv, tmp_path):
    root = str(tmp_path / "db")
    runs = W.ingest(spark, [(csv, "googleplay"), (csv, "apple")], root).orderBy("id").collect()
    assert [(r["platform_key"], r["rows_inserted"], r["rows_skipped"]) for r in runs] == [
        ("googleplay", 5, 1), ("apple", 0, 6)]
    with pytest.raises(ValueError):
        W.ingest(spark, [(csv, "amazon")], root)


def test_dry_run_and_outcome(spark, csv):
    existing = spark.createDataFrame([("b6",)], "review_id string")
    rows_in = combine_sources(spark, [(csv, "apple")])
    out = W.load_outcome(existing, rows_in).first()
    assert (out["rows_in_file"], out["rows_inserted"], out["rows_skipped"],
            out["rows_rejected"]) == (12, 4, 2, 6)
    assert (out["empty_id"], out["empty_text"], out["bad_star"]) == (2, 1, 3)
    dry = W.dry_run(existing, rows_in).first()
    assert (dry["rows_valid"], dry["projected_duplicates"]) == (6, 2)


def test_missing_columns(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.createDataFrame([("a",)], "review_id string").write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="missing required columns"):
        read_clean_reviews(spark, path, "apple")


def test_raw_json(spark, tmp_path):
    path = tmp_path / "page.json"
    path.write_text('{"reviewId":"a","userName":"u","score":5,"at":"2024-01-05 09:00:00",'
                    '"content":" hi "}\n{"reviewId":"b"}\n')
    got = rows(read_raw_reviews(spark, str(path), "App"))
    assert got == [("a", "App", "u", "5", "2024-01-05", "hi"), ("b", "App", "", None, "", "")]


def test_fingerprint_ignores_order_and_sees_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "i int, s string")
    assert fingerprint(df).first() == fingerprint(df.orderBy(F.desc("i"))).first()
    twice = df.unionByName(df)
    assert fingerprint(twice).first()["xor_hash"] == 0
    assert fingerprint(twice).first() != fingerprint(df.filter("false")).first()
    assert portable_fingerprint(df.fillna("")).first() != portable_fingerprint(df).first()


def test_streams(spark, csv, tmp_path):
    pages = str(tmp_path / "pages")
    page = read_clean_reviews(spark, csv, "apple").drop(
        "platform_key", "_source", "_file", "_row")
    for _ in range(2):
        page.write.mode("append").parquet(pages)
    stream = spark.readStream.schema(page.schema).option("maxFilesPerTrigger", 1).parquet(pages)
    out = str(tmp_path / "out")
    write_stream(dedupe_stream(stream), out, str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(out).count() == page.select("review_id").distinct().count()
    root = str(tmp_path / "db")
    ingest_stream(stream, root, "apple", str(tmp_path / "c2")).awaitTermination()
    assert W.read_table(spark, root, "reviews").count() == 5
    assert W.read_table(spark, root, "ingestion_runs").count() == 2


def test_texts_meet_their_ids_once(spark, csv, tmp_path, monkeypatch):
    """The rows written as reviews come from one join of the texts with stored ids."""
    plans = []
    write = W._write

    def keep(df, root, table, load_id):
        if table == "reviews":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, root, table, load_id)

    monkeypatch.setattr(W, "_write", keep)
    W.ingest(spark, [(csv, "apple")], str(tmp_path / "db"))
    assert len(plans) == 1 and plans[0].count("Join") == 1
    assert "Aggregate" not in plans[0] and "Window" not in plans[0].split("Join")[0]


def test_new_rows_by_number(spark):
    rows = spark.createDataFrame(
        [(0, "b", 5, "x", "t1"), (0, "a", 9, "x", "t2"), (1, "a", 0, "y", "t3"),
         (1, "a", 1, "z", "t4")], "_source int, _file string, _row long, review_id string, t string")
    placed = W.numbered_position(rows)
    assert [r["t"] for r in placed.orderBy("_pos").collect()] == ["t2", "t1", "t3", "t4"]
    old = spark.createDataFrame([("z",)], "review_id string")
    new = W.insert_new(old, placed, "review_id", ["_pos"])
    assert {r["t"] for r in new.collect()} == {"t2", "t3"}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_failed_load_leaves_no_staging(spark, csv, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    monkeypatch.setattr(W, "upsert_dim", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        W.ingest(spark, [(csv, "apple")], root)
    assert not W.path_exists(spark, f"{root}/_staging/load_id=1")
    monkeypatch.undo()
    assert W.ingest(spark, [(csv, "apple")], root).first()["rows_inserted"] == 5


def at(minutes):
    return dt.datetime(2024, 1, 5, 10) + dt.timedelta(minutes=minutes)


def test_first_record_of_a_stream_is_kept_whole(spark, tmp_path):
    first = [("a", at(1), 2, "late", 1), ("a", at(0), 1, "first", None), ("b", at(2), 3, None, 4),
             (None, at(2), 4, "no id", 5), (None, at(2), 5, "no id", 5)]
    path = str(tmp_path / "stream")
    schema = "review_id string, at timestamp, place long, review string, star int"
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{path}/page=0")
    time.sleep(1.1)
    changed = [("a", at(-9), 0, "changed", 2), ("c", at(3), 9, "new", 3)]
    spark.createDataFrame(changed, schema).coalesce(1).write.parquet(f"{path}/page=1")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{path}/page=*"))
    out = str(tmp_path / "out")
    kept = dedupe_stream(stream, order=["place"])
    write_stream(kept, out, str(tmp_path / "c")).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert got == {("a", at(0), 1, "first", None), ("b", at(2), 3, None, 4),
                   (None, at(2), 4, "no id", 5), ("c", at(3), 9, "new", 3)}


def test_ids_are_forgotten_after_the_lateness(spark, tmp_path):
    path = str(tmp_path / "stream")
    schema = "review_id string, at timestamp, review string"
    pages = [[("a", at(0), "first")], [("a", at(5), "repeat"), ("b", at(60), "far on")],
             [("a", at(1), "too late"), ("d", at(61), "d")], [("a", at(90), "counts as new")]]
    for k, page in enumerate(pages):
        spark.createDataFrame(page, schema).coalesce(1).write.parquet(f"{path}/page={k}")
        time.sleep(1.1)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{path}/page=*"))
    out = str(tmp_path / "out")
    kept = dedupe_stream(stream, order=["at"], event_time="at", lateness="10 minutes")
    write_stream(kept, out, str(tmp_path / "c")).awaitTermination()
    texts = sorted(r["review"] for r in spark.read.parquet(out).collect())
    assert texts == ["counts as new", "d", "far on", "first"]
    with pytest.raises(ValueError):
        dedupe_stream(stream, lateness="1 hour")


def test_replayed_batch_adds_nothing(spark, csv, tmp_path, monkeypatch):
    pages, root, check = (str(tmp_path / n) for n in ("pages", "db", "check"))
    page = read_clean_reviews(spark, csv, "apple").drop(
        "platform_key", "_source", "_file", "_row").coalesce(1)
    page.write.parquet(pages)
    stream = spark.readStream.schema(page.schema).parquet(pages)
    published = S.ingest_rows

    def crash(*args):
        published(*args)
        raise RuntimeError("stopped after the load, before the stream's own commit")

    with monkeypatch.context() as m:
        m.setattr(S, "ingest_rows", crash)
        with pytest.raises(Exception):
            ingest_stream(stream, root, "apple", check).awaitTermination()
    totals = {r["metric"]: r["n"] for r in W.warehouse_totals(W.read_warehouse(spark, root)).collect()}
    assert totals == {"reviews": 5, "apps": 1, "users": 4, "sentiment_labels": 4}
    ingest_stream(stream, root, "apple", check).awaitTermination()
    assert W.read_table(spark, root, "ingestion_runs").count() == 1  # found, not loaded again
    again = {r["metric"]: r["n"] for r in W.warehouse_totals(W.read_warehouse(spark, root)).collect()}
    assert again == totals

    # a load that failed is made again when its batch is replayed
    root2, check2 = str(tmp_path / "db2"), str(tmp_path / "check2")
    with monkeypatch.context() as m:
        m.setattr(W, "insert_labels", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            ingest_stream(stream, root2, "apple", check2).awaitTermination()
    ingest_stream(stream, root2, "apple", check2).awaitTermination()
    assert W.read_table(spark, root2, "reviews").count() == 5
    files = {r["source_file"].split("#")[1] for r in W.read_table(spark, root2, "ingestion_runs").collect()}
    assert files == {"0"}


def test_compaction(spark, csv, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    assert W.compact(spark, root) == 0
    page = spark.read.options(header=True, multiLine=True, escape='"').csv(csv)
    for k in range(4):
        path = str(tmp_path / f"in{k}")
        page.withColumn("review_id", F.when(F.trim("review_id") != "", F.concat(
            "review_id", F.lit(f"-{k // 2}")))).write.option("header", True).parquet(path)
        W.ingest(spark, [(path, "apple")], root, fmt="parquet")
    with monkeypatch.context() as m:
        m.setattr(W, "insert_labels", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            W.ingest(spark, [(csv, "googleplay")], root)

    def seen():
        wh = W.read_warehouse(spark, root)
        return {t: (df.count(), fingerprint(df).first()) for t, df in wh.items()}

    before, reader = seen(), W.read_warehouse(spark, root)["reviews"]
    assert before["reviews"][0] == 10 and before["ingestion_runs"][0] == 5

    # one that stops before it is published changes nothing
    write = W._write
    with monkeypatch.context() as m:
        m.setattr(W, "_write", lambda df, r, table, n: 1 / 0 if table == W.SNAPSHOTS
                  else write(df, r, table, n))
        with pytest.raises(ZeroDivisionError):
            W.compact(spark, root)
    assert seen() == before

    made = W.compact(spark, root)
    assert seen() == before and W._snapshot(spark, root) == made
    assert reader.count() == 10  # older readers go on
    W.ingest(spark, [(csv, "apple")], root)
    after = seen()
    assert after["reviews"][0] == 15 and after["ingestion_runs"][0] == 6
    ids = [r["id"] for r in W.read_table(spark, root, "reviews").orderBy("id").collect()]
    assert ids == list(range(1, 16))

    assert W.compact(spark, root) > made and seen() == after
    gone = W.drop_superseded(spark, root)
    assert len(gone) > 20 and seen() == after
    for table in ("reviews", "apps", "users", "platforms", "sentiment_labels", W.SNAPSHOTS):
        assert len(W._listed(spark, f"{root}/{table}")) == 1
    assert W.drop_superseded(spark, root) == []
