"""Streams must end where the batch queries end, also after restarts, repeats and late rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from tidemark import schemas
from tidemark.functions import ids
from tidemark.operators import company as co, ingest as ing
from tidemark.sources import tables
from tidemark.streaming import generations, layers, replay, sources, state


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


RECORDS = [("c1", "Thtion thing word\nword", "s1"), ("c2", "erble thing ering", "s1"), ("c3", "word up", "s2")]


def land(folder, records, name):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"key": "raw_data", "value": json.dumps({"comment_id": i, key: t, "subreddit": s})}) for i, t, s, key in records]
    (folder / name).write_text("\n".join(lines))


def record_stream(spark, folder, max_files=1):
    return sources.parse_records(sources.landed_stream(spark, str(folder), schemas.ENVELOPE, "json", max_files))


def test_layers(spark, tmp_path):
    land(tmp_path / "in", [(*r, "raw_text") for r in RECORDS[:2]], "a.json")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    clock = iter([10.0, 20.0])
    run = lambda: layers.run_layers(record_stream(spark, tmp_path / "in"), out, checkpoint, every=None, clock=lambda: next(clock)).awaitTermination()
    run()
    first = dict(rows(layers.word_frequency(spark, out).select("word", "count")))
    assert first == {"thtion": 1, "thing": 2, "wordword": 1, "erble": 1, "ering": 1}
    land(tmp_path / "in", [(*r, "message") for r in RECORDS[2:]], "b.json")  # replayed messages name the text differently
    run()  # restart from the checkpoint: only the new file is read
    state_now = {r["word"]: (r["count"], r["timestamp"]) for r in layers.word_frequency(spark, out).collect()}
    assert state_now["thing"] == (2, 10.0) and state_now["word"] == (1, 20.0)
    raw = spark.read.parquet(f"{out}/{layers.RAW}")
    assert {(r["comment_id"], r["insert_time"]) for r in raw.collect()} == {("c1", 10.0), ("c2", 10.0), ("c3", 20.0)}
    scored = {r["comment_id"]: r for r in spark.read.parquet(f"{out}/{layers.SENTIMENT}").collect()}
    assert scored["c2"]["negative"] > scored["c2"]["positive"] and len(scored) == 3
    company = spark.read.parquet(f"{out}/{layers.COMPANY}")
    assert {r["company"] for r in company.collect()} == {"thing", "ering"}
    series = spark.read.parquet(f"{out}/{layers.SERIES}")
    assert series.where("word = 'thing'").count() == 2


def test_repeated_batch_counts_once_and_compaction_keeps_totals(spark, tmp_path):
    out = str(tmp_path)
    batch = lambda text: spark.createDataFrame([("c", text)], "comment_id string, raw_text string")
    layers.word_layer(batch("x x"), 1.0, out, 0)
    layers.word_layer(batch("x x"), 2.0, out, 0)  # the same batch again
    layers.word_layer(batch("x y"), 3.0, out, 1)
    want = [("x", 3, 3.0), ("y", 1, 3.0)]
    assert rows(layers.word_frequency(spark, out)) == want
    layers.compact_word_frequency(spark, out, 0)
    assert rows(layers.word_frequency(spark, out)) == want
    layers.word_layer(batch("y"), 4.0, out, 2)
    layers.compact_word_frequency(spark, out, 1)
    layers.compact_word_frequency(spark, out, 1)
    assert rows(layers.word_frequency(spark, out)) == [("x", 3, 3.0), ("y", 2, 4.0)]


def test_empty_batches_leave_nothing(spark, tmp_path):
    land(tmp_path / "in", [(*RECORDS[0], "raw_text")], "a.json")
    stream = sources.subreddit_stream(record_stream(spark, tmp_path / "in"), "other")
    layers.run_layers(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every=None).awaitTermination()
    assert not (tmp_path / "out").exists()


@pytest.fixture()
def daily_files(spark, data, tmp_path):
    """Events as (event_id, company, scores, ts), one file per day in order, day 2 twice, one late row last."""
    events = tables.load_table(spark, data, "events").select(
        "event_id", F.col("event_type").alias("company"), *[(F.col("value") / 500).alias(c) for c in co.LABELS],
        ids.utc(F.col("ts")).alias("ts"),
    )
    folder = str(tmp_path / "days")
    day = lambda n: events.where(F.dayofmonth("ts") == n).coalesce(1).write.mode("append").parquet(folder)
    for n in (1, 2, 3, 4, 5):
        day(n)
    day(2)
    late = events.where(F.dayofmonth("ts") == 1).limit(1).withColumn("event_id", F.lit(999999).cast("bigint"))
    late.coalesce(1).write.mode("append").parquet(folder)
    schema = "event_id bigint, company string, positive double, negative double, neutral double, ts timestamp"
    stream = sources.landed_stream(spark, folder, schema, max_files=1)
    return events.where(F.dayofmonth("ts") <= 5), stream


def test_windowed_company_equals_batch_without_late_row(spark, daily_files, tmp_path):
    batch, stream = daily_files
    unique = state.dedup(stream, "event_id", "ts", delay="1 day")
    rolled = state._rolled(unique, "ts", "1 day", None)
    state.write_updates(rolled, str(tmp_path / "out"), str(tmp_path / "cp"), mode="append").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("company", "window_end", "count")
    want = batch.groupBy("company", F.date_trunc("day", "ts").alias("d")).count()
    want = want.select("company", F.expr("d + INTERVAL 1 DAY"), "count")
    closed = rows(got)
    assert closed and set(closed) <= set(rows(want))
    assert {r[1] for r in closed} >= {datetime(2024, 1, 2), datetime(2024, 1, 3)}


def test_update_mode_company_windows(spark, daily_files, tmp_path):
    batch, stream = daily_files
    rolled = state.company_windows(stream.where("event_id < 999999").dropDuplicates(["event_id"]), "ts", "1 day", delay="60 days")
    state.write_updates(rolled, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = state.latest(spark, str(tmp_path / "out"), ["company", "window_end"])
    want = batch.groupBy("company", F.expr("date_trunc('day', ts) + INTERVAL 1 DAY").alias("w")).agg(F.avg("positive").alias("p"), F.count("*").alias("n"))
    rounded = lambda df: rows(df.select(df.columns[0], df.columns[1], F.round(df.columns[2], 9), df.columns[-1]))
    assert rounded(got.select("company", "window_end", "positive", "count")) == rounded(want)


def test_dedup_drops_repeats(spark, daily_files, tmp_path):
    batch, stream = daily_files
    unique = state.dedup(stream.where("event_id < 999999"), "event_id", "ts", delay="60 days").select("event_id")
    state.write_updates(unique, str(tmp_path / "out"), str(tmp_path / "cp"), mode="append").awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("event_id")) == rows(batch.select("event_id"))


def test_running_counts_in_rocksdb_survive_a_restart(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    state.use_rocksdb(spark)
    try:
        out, cp, folder = str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "in")
        for texts in (["x y", "x"], ["y z"]):
            spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").json(folder)
            counted = state.running_word_count(sources.landed_stream(spark, folder, "text string", "json", 1), F.col("text"))
            state.write_updates(counted, out, cp).awaitTermination()
        assert rows(state.latest(spark, out, ["word"])) == [("x", 2), ("y", 2), ("z", 1)]
    finally:
        spark.conf.set(provider, before)


def test_replay_keeps_order_and_equals_batch(spark, data, tmp_path):
    events = tables.load_table(spark, data, "events")
    start, end = datetime(2024, 1, 3), datetime(2024, 1, 6)
    folder = str(tmp_path / "topic")
    replay.replay_slices(events, "ts", "event_type", folder, start, end, timedelta(days=1))
    seen = []

    def handle(batch, _):
        times = [json.loads(r["value"])["created_utc"] for r in batch.collect()]
        seen.append((min(times), max(times), len(times)))

    stream = sources.landed_stream(spark, folder, schemas.ENVELOPE, "json", max_files=1)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    days = [low[:10] for low, _, _ in seen]
    assert days == sorted(days)
    wanted = ing.time_range(events, "ts", ids.moment(start), ids.moment(end)).count()
    assert sum(n for _, _, n in seen) == wanted


def test_replayed_slice_keeps_order_and_repeats_nothing(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "RANGE_ROWS", 10)
    events = tables.load_table(spark, data, "events").withColumn("id", F.col("event_id").cast("string"))
    folder, day = tmp_path / "topic", timedelta(days=1)
    start = datetime(2024, 1, 3)
    for _ in range(2):  # the second run repeats what the first has written
        replay.replay_slices(events, "ts", "id", str(folder), start, start + 2 * day, day)
    for n in range(2):
        low = start + n * day
        files = sorted((folder / f"slice={(low - datetime(1970, 1, 1)) // timedelta(seconds=1)}").glob("part-*.json"))
        sent = [json.loads(json.loads(line)["value"])["message"] for f in files for line in f.read_text().splitlines()]
        found = ing.time_range(events, "ts", ids.moment(low), ids.moment(low + day)).orderBy("ts", "id").collect()
        assert len(files) > 1 and sent == [r["id"] for r in found]


def test_held_records_are_released_in_event_order(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "part string, ts timestamp, n bigint, word string"
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    batches = [
        [("a", at(9), 1, "x"), ("a", at(2), 2, None), ("b", at(5), 3, "z"), ("a", at(2), 1, "tie"), (None, at(1), 1, "no key"), ("a", None, 1, "no time")],
        [("a", at(4.5), 4, "behind"), ("a", at(30), 5, "y"), ("b", at(29), 6, "y")],
        [("a", at(1), 7, "too late"), ("a", at(200), 8, "held"), ("b", at(31), 9, "last")],
    ]
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    state.use_rocksdb(spark)
    try:
        for batch in batches:  # a run per batch: the held rows survive the restarts
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
            stream = sources.landed_stream(spark, folder, schema, max_files=1)
            ordered = replay.in_event_order(stream, "part", "ts", "n", "10 seconds")
            state.write_updates(ordered, str(tmp_path / "out"), str(tmp_path / "cp"), mode="append").awaitTermination()
    finally:
        spark.conf.set(provider, before)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("part", "offset").collect()
    want = [("a", 0, 1, "tie"), ("a", 1, 2, None), ("a", 2, 4, "behind"), ("a", 3, 1, "x"), ("a", 4, 5, "y"), ("b", 0, 3, "z"), ("b", 1, 6, "y"), ("b", 2, 9, "last")]
    assert [(r["part"], r["offset"], r["n"], r["word"]) for r in got] == want
    assert [r["ts"] for r in got if r["part"] == "a"] == [at(s) for s in (2, 2, 4.5, 9, 30)]


def test_generations_bound_what_a_reader_opens(spark, tmp_path, monkeypatch):
    folder, span = str(tmp_path / "out"), 2
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def land_and_run(text):
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.mode("append").json(source)
        counted = state.running_word_count(sources.landed_stream(spark, source, "text string", "json", 1), F.col("text"))
        generations.write(counted, folder, checkpoint, ["word"], span).awaitTermination()

    with pytest.raises(ValueError):
        generations.latest(spark, folder, ["word"])
    words, want = ["x y", "x", "z", "x x", "y"], {}
    for n, text in enumerate(words):
        land_and_run(text)
        for w in text.split():
            want[w] = want.get(w, 0) + 1
        found = generations.latest(spark, folder, ["word"])
        assert dict(rows(found)) == want
        gen = n // span
        opened = {f.split("/out/")[1].rsplit("/", 1)[0] for f in found.inputFiles()}
        assert opened <= {f"base/gen={gen}"} | {f"tail/gen={gen}/batch_id={b}" for b in range(gen * span, n + 1)}

    broken = generations._newest

    def fails(parts, keys):
        broken(parts, keys).write.mode("overwrite").parquet(f"{folder}/base/gen=3")  # half done: written, not in the manifest
        raise RuntimeError("lost")

    land_and_run("y")
    want["y"] += 1
    with monkeypatch.context() as m:
        m.setattr(generations, "_newest", fails)
        with pytest.raises(RuntimeError):
            generations.compact(spark, folder, ["word"], 3)
    assert generations.newest_generation(spark, folder) == 2
    assert dict(rows(generations.latest(spark, folder, ["word"]))) == want
    land_and_run("x")
    want["x"] += 1
    assert generations.newest_generation(spark, folder) == 3
    assert dict(rows(generations.latest(spark, folder, ["word"]))) == want


def test_first_record_per_topic_partition(spark, tmp_path):
    envelope = [("k", f"v{o}", "t", p, o) for p in (0, 1) for o in (7, 3, 5)]
    schema = "key string, value string, topic string, partition int, offset bigint"
    spark.createDataFrame(envelope, schema).coalesce(1).write.json(str(tmp_path / "in"))
    stream = sources.landed_stream(spark, str(tmp_path / "in"), schema, "json")
    layers.first_records(stream, str(tmp_path / "out"), str(tmp_path / "cp"), every=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / layers.FIRST))
    assert rows(got.select("partition", "offset", "value")) == [(0, 3, "v3"), (1, 3, "v3")]


def test_rule_works_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("Amazon layoff", "en"), ("Amazon", "en")], "text string, lang string").write.json(str(tmp_path / "in"))
    stream = sources.landed_stream(spark, str(tmp_path / "in"), "text string, lang string", "json")
    hits = stream.where(ing.follows_rule(F.col("text"), F.col("lang"), "amazon", ["layoff"]))
    query = hits.writeStream.format("memory").queryName("samples").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("samples").count() == 1


def test_topic_options():
    one = sources.topic_options("host:1", "reddit", partition=0)
    assert one["assign"] == '{"reddit": [0]}' and one["startingOffsets"] == "latest"
    assert sources.topic_options("host:1", "reddit")["subscribe"] == "reddit"


def test_released_ticks_are_numbered_in_one_call_a_key():
    class State:
        value, calls = (4,), 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    class Handle:
        getValueState = staticmethod(lambda name, schema: sent)

    sent, numbered = State(), replay._Numbered()
    numbered.init(Handle)
    ticks = [Row(_start=n, _n=2, _rows=f"rows of {n}") for n in (3, 1, 2)]
    got = list(numbered.handleInputRows(("a",), iter(ticks), None))
    assert [(r["_key"], r["_first"], r["_rows"]) for r in got] == [("a", 4, "rows of 1"), ("a", 6, "rows of 2"), ("a", 8, "rows of 3")]
    assert sent.value == (10,) and sent.calls == 2
