"""Streaming operators: I1 cleaning, each page once; I2 title de-duplication."""

import json
import os
import tempfile

import pytest

from elcorpus.sources.readers import CLEANED_SCHEMA


def test_dedupe_titles_state_is_bounded(spark):
    """Every batch brings new titles a day later than the last: repetitions
    within two days go.  A title is forgotten when the watermark, two days behind
    the newest row, is two days past it: the state holds at most five days."""
    from elcorpus.streaming import STATE_STORE, dedupe_titles
    base = tempfile.mkdtemp(prefix="elcorpus-stream-")
    schema = "title string, n int, fetched timestamp"
    os.makedirs(f"{base}/in")
    for day in range(12):
        rows = [{"title": f"T{day}-{i}", "n": 1, "fetched": f"2024-03-{day + 1:02d}T00:00:{i:02d}Z"} for i in range(40)]
        rows += [dict(r, n=2) for r in rows[:20]] + ([{"title": f"T{day - 1}-3", "n": 3, "fetched": f"2024-03-{day + 1:02d}T00:00:00Z"}] if day else [])
        if day == 11:
            rows.append({"title": "T0-0", "n": 4, "fetched": "2024-03-12T00:00:00Z"})  # long forgotten
        with open(f"{base}/in/{day:02d}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(f"{base}/in/{day:02d}.json", (1_700_000_000 + day, 1_700_000_000 + day))
    old = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{base}/in")
        q = (dedupe_titles(stream, "fetched", "2 days").writeStream.format("memory").queryName("dedup_titles")
             .option("checkpointLocation", f"{base}/ckpt").outputMode("append").start())
        q.processAllAvailable()
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        q.stop()
    finally:
        spark.conf.set(STATE_STORE[0], old)
    got = sorted((r.title, r.n) for r in spark.table("dedup_titles").collect())
    assert got == sorted([(f"T{d}-{i}", 1) for d in range(12) for i in range(40)] + [("T0-0", 4)])
    assert max(kept) <= 5 * 40 + 1 and kept[-1] <= max(kept[4:7]) + 1  # not 12 * 40


def test_stream_of_records_without_ids_over_earlier_output(spark):
    """Records (page, url, text) as they are fetched; titles of an output
    that is older than the index are not cleaned again."""
    import json
    import os

    from elcorpus.streaming.incremental import start_incremental_clean
    base = tempfile.mkdtemp(prefix="elcorpus-stream-")
    html = '<html><body><div id="mw-content-text"><div class="mw-parser-output"><p>text of %s</p></div></div></body></html>'
    spark.createDataFrame([("T0", "u", "", "earlier")], CLEANED_SCHEMA).coalesce(1).write.json(f"{base}/out")
    os.mkdir(f"{base}/in")
    for k, titles in enumerate((["T1", "T2"], ["T0", "T3", "T1"])):
        with open(f"{base}/in/{k}.json", "w") as f:
            f.writelines(json.dumps({"page": t, "url": "u", "text": html % t}) + "\n" for t in titles)
        start_incremental_clean(spark, f"{base}/in", f"{base}/out", f"{base}/err", checkpoint=f"{base}/ckpt").awaitTermination()
    got = sorted((r.title, r.text) for r in spark.read.schema(CLEANED_SCHEMA).json(f"{base}/out").collect())
    assert got == [("T0", "earlier"), ("T1", "text of T1"), ("T2", "text of T2"), ("T3", "text of T3")]


HTML = '<html><body><div id="mw-content-text"><div class="mw-parser-output"><p>text of %s</p></div></div></body></html>'
BROKEN = "<html><body><p>no container</p></body></html>"


def _inbox(base, name, records):
    import json
    import os
    os.makedirs(f"{base}/in", exist_ok=True)
    with open(f"{base}/in/{name}.json", "w") as f:
        f.writelines(json.dumps({"page": t, "url": u, "text": h}) + "\n" for t, u, h in records)


def _result(spark, base):
    from elcorpus.sources.readers import read_cleaned_pages
    rows = sorted((r.title, r.text) for r in read_cleaned_pages(spark, f"{base}/out").collect())
    errors = sorted((r.title, r.url) for r in spark.read.schema("title string, url string").json(f"{base}/err").collect())
    return rows, errors


class Ended(Exception):
    pass


def _ended_after(writer_class, step):
    """A writer that is ended right after one of its writes."""
    from elcorpus.sinks.commits import CommitLog

    class Log(CommitLog):
        moved = 0

        def commit(self, *args):
            out = super().commit(*args)
            if step == "commit":
                raise Ended(step)
            return out

        def _move(self, *args):
            super()._move(*args)
            Log.moved += 1
            if step == "move" and Log.moved == 1:
                raise Ended(step)

    class Writer(writer_class):
        def log(self, spark):
            own = super().log(spark)
            return Log(spark, own.root, own.tables)

    def ended(name):
        def method(self, *args):
            getattr(writer_class, name)(self, *args)
            raise Ended(name)
        return method

    if step.startswith("write_"):
        setattr(Writer, step, ended(step))
    return Writer


@pytest.mark.parametrize("step", ["write_cleaned", "write_errors", "write_titles", "commit", "move"])
def test_ended_and_replayed_batches_are_written_once(spark, step):
    from pyspark.errors import StreamingQueryException

    from elcorpus.streaming import CleanWriter, start_incremental_clean
    base = tempfile.mkdtemp(prefix="elcorpus-once-")
    first = [(f"T{k}", "u1", HTML % f"T{k}") for k in range(8)] + [("E0", "u1", BROKEN), ("E1", "u1", BROKEN)]
    _inbox(base, "0", first)
    writer = _ended_after(CleanWriter, step)(f"{base}/out", f"{base}/err")
    with pytest.raises(StreamingQueryException):
        start_incremental_clean(spark, f"{base}/in", f"{base}/out", f"{base}/err", writer=writer).awaitTermination()
    _inbox(base, "1", [("T1", "u2", HTML % "again"), ("T8", "u2", HTML % "T8"), ("E0", "u2", HTML % "E0"), ("E2", "u2", BROKEN)])
    for _ in range(2):  # a second start finds nothing to do
        start_incremental_clean(spark, f"{base}/in", f"{base}/out", f"{base}/err").awaitTermination()
    rows, errors = _result(spark, base)
    assert rows == sorted([(f"T{k}", f"text of T{k}") for k in range(9)] + [("E0", "text of E0")])
    assert errors == [("E0", "u1"), ("E1", "u1"), ("E2", "u2")]


def test_nothing_of_a_batch_is_seen_before_its_commit(spark):
    import os

    from elcorpus.streaming import CleanWriter
    base = tempfile.mkdtemp(prefix="elcorpus-once-")
    batch = spark.createDataFrame([(1, "T", "u", HTML % "T")], "input_seq long, page string, url string, text string")
    for step in ("write_cleaned", "write_errors", "write_titles"):
        with pytest.raises(Ended):
            _ended_after(CleanWriter, step)(f"{base}/out", f"{base}/err").write(batch, "w", 0)
        assert not os.path.exists(f"{base}/out") and not os.path.exists(f"{base}/err")
    CleanWriter(f"{base}/out", f"{base}/err").write(batch, "w", 0)
    assert _result(spark, base) == ([("T", "text of T")], [])
    CleanWriter(f"{base}/out", f"{base}/err").write(batch, "other", 0)  # a stream that lost its checkpoint
    assert _result(spark, base) == ([("T", "text of T")], [])


def test_title_index_reads_do_not_grow(spark):
    """20 batches of 60 titles: a lookup reads as much of a generation at the
    end as early on, and there are few generations, while the index grows."""
    import os

    from elcorpus.operators.title_index import TitleIndex
    path = tempfile.mkdtemp(prefix="elcorpus-index-") + "/titles"
    frame = lambda names: spark.createDataFrame([(t,) for t in names], "title string")
    size = lambda p: sum(os.path.getsize(f"{p}/{n}") for n in os.listdir(p) if n.endswith(".parquet"))
    state, read, total, generations = None, [], [], []
    for k in range(20):
        index = TitleIndex(spark, path, state, bucket_titles=30)
        index.sweep()
        new = [f"title {k} {i}" for i in range(60)]
        old = [f"title {j} {j}" for j in range(k)]
        asked = frame(new[:3] + old[-3:])
        paths = index.paths(asked)
        read.append(sum(map(size, paths)))
        total.append(sum(g["titles"] for g in index.generations))
        generations.append(len(index.generations))
        found = index.lookup(asked)
        found = {r.title for r in found.collect()} if found is not None else set()
        assert set(old[-3:]) <= found and not set(new) & found
        index.add(frame(new), f"g{k}")
        state = index.generations
    assert total[-1] == 19 * 60
    assert max(generations) <= 3 * 3  # three of each of the three levels
    each = [r / max(1, g) for r, g in zip(read, generations, strict=True)]
    assert max(each[10:]) <= 1.3 * max(each[2:10])
    assert read[19] <= 1.3 * read[7]  # as many generations, the index 2.7 times as large
    index = TitleIndex(spark, path, state, bucket_titles=30)
    assert {r.title for r in index.all_titles().collect()} == {f"title {k} {i}" for k in range(20) for i in range(60)}
