from __future__ import annotations

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from solstrand.operators import articles
from solstrand.plans.messages import article_messages, article_scorer, survey_scorer
from solstrand.sinks.scratch import scratch_path
from solstrand.sources.messages import file_stream, table_stream
from solstrand.streaming.dedup import first_seen
from solstrand.streaming.hops import PROVIDER, ArticleStream, append
from tests.test_articles import message

SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def article(i: int | None, words: str = "the cat and the dog") -> str:
    return json.dumps({"id": i, "title": f"t{i}", "description": words, "href": f"h{i}"})


@pytest.fixture
def land(spark):
    """Writes batches of messages as files of one folder, one file each."""

    def write(folder: str, *batches):
        for rows in batches:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return folder

    return write


def ids(spark, stream, root: str) -> list:
    append(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return sorted(r["id"] for r in spark.read.schema(stream.schema).parquet(f"{root}/rows").collect())


HOT = [message(100 + i, article(7)) for i in range(60)]  # two thirds of all rows are one id
MIXED = [message(i, article(i % 20)) for i in range(30)]


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("bounded", [False, True])
def test_stream_keeps_one_row_per_id_like_the_batch(spark, land, tmp_path, salts, bounded):
    folder = land(str(tmp_path / "in"), MIXED, HOT, MIXED)
    stream = articles.flatten_articles(
        articles.parse_messages(file_stream(spark, folder, files_per_trigger=1))
    )
    got = ids(spark, first_seen(stream, bounded=bounded, salts=salts), str(tmp_path / "out"))
    batch = articles.first_per_id(
        articles.flatten_articles(articles.parse_messages(spark.read.schema(SCHEMA).parquet(folder)))
    )
    assert got == sorted(r["id"] for r in batch.collect()) == list(range(20))


def test_bounded_state_forgets(spark, land, tmp_path):
    month = 60 * 24 * 30
    folder = str(tmp_path / "in")
    out, kept = str(tmp_path / "out"), []
    for minutes in (0, month, 2 * month):
        # A later article of another id moves the watermark on.
        land(folder, [message(minutes, article(1)), message(minutes + 1, article(minutes + 2))])
        stream = articles.flatten_articles(articles.parse_messages(file_stream(spark, folder)))
        kept = ids(spark, first_seen(stream, bounded=True, salts=1), out)
    assert kept.count(1) > 1


def test_late_rows_are_left_out(spark, land, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: first_seen(
        articles.flatten_articles(articles.parse_messages(file_stream(spark, folder)))
    )
    land(folder, [message(60 * 24 * 30, article(1))])
    ids(spark, stream(), out)
    land(folder, [message(0, article(2)), message(60 * 24 * 29, article(3))])
    assert ids(spark, stream(), out) == [1, 3]


def hops(root: str) -> ArticleStream:
    return ArticleStream(root, article_scorer(), survey_scorer, salts=4)


def test_all_hops_and_a_second_run(spark, land, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "tables")
    land(
        folder,
        [message(0, article(1)), message(1, article(1)), message(2, "bad"), message(3, "")],
        [message(4, article(2, "der Hund und der Ball")), message(5, article(3), topic=None)],
    )
    run = hops(root)
    ended = run.run(file_stream(spark, folder))
    counts = {hop: run.read(spark, hop).count() for hop in run.HOPS}
    assert counts == {"bronze": 6, "silver": 3, "surveys": 3, "options": 3 + 4 + 3}
    seen = [dict(p.observedMetrics) for p in ended["bronze"].recentProgress]
    total = {k: sum(m["bronze"][k] for m in seen if "bronze" in m) for k in ("rows", "valid_topic")}
    assert total == {"rows": 6, "valid_topic": 1}
    by_city = run.read(spark, "silver").groupBy("ai_city").count().collect()
    assert {r["ai_city"]: r["count"] for r in by_city} == {"London": 2, "Berlin": 1}

    # Nothing new: nothing is written again.
    again = hops(root)
    again.run(file_stream(spark, folder))
    assert {hop: again.read(spark, hop).count() for hop in again.HOPS} == counts

    # New messages go through all hops; a known id does not.
    land(folder, [message(6, article(1)), message(7, article(9))])
    more = hops(root)
    more.run(file_stream(spark, folder))
    assert {hop: more.read(spark, hop).count() for hop in more.HOPS} == {
        "bronze": 8, "silver": 4, "surveys": 4, "options": 13,
    }


def test_bronze_is_stored_by_day(spark, land, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "tables")
    land(folder, [message(0, article(1)), message(60 * 24, article(2))])
    run = hops(root)
    run.run(file_stream(spark, folder), upto="bronze")
    day = datetime.date(2024, 5, 2)
    one = run.read(spark, "bronze").filter(F.col("eh_enqueued_date") == day)
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(eh_enqueued_date" in (
        one._jdf.queryExecution().executedPlan().toString()
    )


def test_the_session_keeps_its_settings(spark, land, tmp_path):
    before = spark.conf.get(PROVIDER)
    folder, out = land(str(tmp_path / "in"), MIXED), str(tmp_path / "out")
    stream = articles.flatten_articles(articles.parse_messages(file_stream(spark, folder)))
    query = append(first_seen(stream, salts=1), f"{out}/rows", f"{out}/c")
    query.awaitTermination()
    assert spark.conf.get(PROVIDER) == before
    state = query.recentProgress[0].stateOperators[0]
    assert any(k.startswith("rocksdb") for k in state.customMetrics)


def test_unknown_hop(spark, land, tmp_path):
    folder = land(str(tmp_path / "in"), MIXED)
    with pytest.raises(ValueError):
        hops(str(tmp_path / "t")).start("gold", file_stream(spark, folder))


def test_a_table_as_a_stream(spark, tmp_path):
    spark.range(5).write.mode("overwrite").saveAsTable("stream_source")
    out = str(tmp_path)
    append(table_stream(spark, "stream_source"), f"{out}/rows", f"{out}/c").awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 5
    spark.sql("DROP TABLE stream_source")


def test_scratch_folders_are_never_shared(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_large_batches_land_as_more_files(spark, tmp_path, monkeypatch):
    """A batch of many rows lands as files of FILE_ROWS, each row once; a small one as three files."""
    from solstrand.plans import live

    monkeypatch.setattr(live, "FILE_ROWS", 10)
    rows = spark.createDataFrame([(i, int(i >= 95)) for i in range(100)], "n int, batch int").repartition(4)
    landed = []

    class Ended:
        def awaitTermination(self):
            landed.append(len(list((tmp_path / "in").glob("*.parquet"))))

    live._in_runs(rows, str(tmp_path), lambda stream: Ended())
    assert landed == [10, 13]
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "in")).collect()) == list(range(100))


def test_stream_tables_are_zstd(spark, tmp_path):
    from solstrand.sources.messages import file_stream
    from solstrand.streaming.hops import append

    spark.range(9).write.parquet(str(tmp_path / "in"))
    append(file_stream(spark, str(tmp_path / "in"), "id long"), str(tmp_path / "out"), str(tmp_path / "done")).awaitTermination()
    assert list((tmp_path / "out").glob("*.zstd.parquet")) and spark.read.parquet(str(tmp_path / "out")).count() == 9


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_batch_leaves_nothing_of_its_shuffles(spark, land, tmp_path):
    folder, out = land(str(tmp_path / "in"), MIXED, HOT), str(tmp_path / "out")
    before = shuffle_files(spark)
    stream = articles.flatten_articles(articles.parse_messages(file_stream(spark, folder, files_per_trigger=1)))
    query = append(first_seen(stream, salts=4), f"{out}/rows", f"{out}/c")
    query.awaitTermination()
    assert sum(p.numInputRows for p in query.recentProgress) == len(MIXED) + len(HOT)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left


def test_hops_in_batches_of_bytes(spark, land, tmp_path):
    """The table of a hop is worked off in many batches and gives the rows of one."""
    folder = land(str(tmp_path / "in"), *[[message(i, article(i)), message(i + 1, article(i % 3))] for i in range(5)])
    run = ArticleStream(str(tmp_path / "t"), article_scorer(), survey_scorer, bytes_per_trigger=1, salts=4)
    ended = run.run(file_stream(spark, folder), upto="silver")
    files = len(list((tmp_path / "t/bronze").glob("*/*.parquet")))
    assert sum(p.numInputRows > 0 for p in ended["silver"].recentProgress) == files > 1
    assert sorted(r.id for r in run.read(spark, "silver").collect()) == list(range(5))


def test_articles_are_made_behind_the_join_with_labels(spark):
    """An exchange for the join carries the text once, not the article beside it."""
    documents = spark.createDataFrame([(1, "a\nb", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = article_messages(documents, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS article#" in plan and "AS article#" not in plan[plan.index("Join ") :]
