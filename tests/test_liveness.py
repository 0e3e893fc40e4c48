import datetime as dt

from helpers import NOW
from test_streams import as_files

from runlake.operators import sessions
from runlake.streaming import liveness
from runlake.streaming import jobs as streams
from runlake.streaming.batches import read_batches, run_available, schema_of


def test_timers_report_each_silence_once(spark, tmp_path):
    empty = spark.createDataFrame([], "run_id string, worker_id string, attempt int, ts timestamp")
    at = lambda s: NOW + dt.timedelta(seconds=s)
    beats = lambda *rows: [(run, "w", 1, at(s)) for run, s in rows]
    # Later rows of other runs move the watermark; "b" is alive at a gap equal to the limit.
    parts = [beats(("a", 0), ("b", 0)), beats(("b", 15), ("z", 16)), beats(("b", 30), ("z", 31)), beats(("z", 40)), beats(("z", 90)), beats(("z", 200))]
    stream = liveness.stale_owners(as_files(spark, empty, parts, tmp_path), 15, "0 seconds")
    run_available(stream, streams.append_writer(f"{tmp_path}/out"), "t")
    got = read_batches(spark, f"{tmp_path}/out", schema_of(stream)).collect()
    assert sorted((r.run_id, r.last_heartbeat, r.reap_at) for r in got) == [
        ("a", at(0), at(15)), ("b", at(30), at(45)), ("z", at(40), at(55)), ("z", at(90), at(105))]
    beats_all = spark.createDataFrame(sum(parts, []), empty.schema)
    batch = sessions.heartbeat_sessions(beats_all, 15, liveness.OWNER).filter(f"reap_at < timestamp'{at(200)}'")
    assert sorted((r.run_id, r.last_heartbeat) for r in batch.collect()) == sorted((r.run_id, r.last_heartbeat) for r in got)


def test_a_batch_holds_slots_not_heartbeats():
    """Half a million heartbeats of one owner, in no order, with one silence among them."""
    import random

    class Value:
        def __init__(self):
            self.now = None

        def get(self):
            return self.now

        def update(self, value):
            self.now = value

        def getValueState(self, *_):
            return self

        def registerTimer(self, ms):
            self.timer = ms
    timer, handle = liveness.SilenceTimer(liveness.OWNER, 15, by_clock=False), Value()
    timer.init(handle)
    order = [i for i in range(500_000) if not 300_000 <= i < 320_000]
    random.Random(1).shuffle(order)
    import tracemalloc
    tracemalloc.start()
    found = list(timer.handleInputRows(("r", "w", 1), ({"_us": i * 1000} for i in order), None))
    assert tracemalloc.get_traced_memory()[1] < 1_000_000
    tracemalloc.stop()
    assert [r.last_heartbeat.timestamp() for r in found] == [299.999] and handle.now[0] == 499_999_000
