"""Kill and restart the exactly-once sink at every step."""

import datetime
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_topics import records
from tidelog.operators.ledger import pending_ranges, range_continuity, resume_position
from tidelog.sources.topics import DataLossError, TopicSpec, publish, publish_slice, read_topic_stream
from tidelog.streaming.exactly_once import (
    AFTER_CLAIM, AFTER_COMMIT, AFTER_WRITE, ClaimRefusedError, ExactlyOnceSink, compact_ledger, read_ledger, read_output, run_exactly_once,
)

APP = "app"
EXPECTED = sorted([(0, o) for o in range(40)] + [(1, o) for o in range(25)], key=str)


class Killed(RuntimeError):
    pass


class Setup:
    def __init__(self, spark, path, files_per_batch=2):
        self.spark, self.ledger, self.output = spark, path("ledger"), path("output")
        self.spec = TopicSpec("t", root=path("topic"), max_files_per_trigger=files_per_batch)

    def publish(self):
        publish(records(self.spark, {0: 40, 1: 25}), self.spec, offsets_per_slice=10)

    def sink(self, kill=None, **options):
        def on_stage(stage, batch_id):
            if kill == (stage, batch_id):
                raise Killed

        options.setdefault("process", lambda df: df.select("partition", "offset"))
        return ExactlyOnceSink(
            self.spark, application_id=APP, topic="t", ledger_path=self.ledger, output_path=self.output,
            on_stage=on_stage, **options,
        )

    def run(self, checkpoint=None, kill=None, **options):
        sink = self.sink(kill, **options)
        sink.recover(self.spec)
        run_exactly_once(read_topic_stream(self.spark, self.spec), sink, checkpoint=checkpoint).awaitTermination()
        return sink

    def visible(self):
        return rows(read_output(self.spark, self.output, self.ledger), "partition", "offset")

    def events(self):
        return read_ledger(self.spark, self.ledger)


@pytest.fixture
def setup(spark, path):
    made = Setup(spark, path)
    made.publish()
    return made


@pytest.mark.parametrize("same_checkpoint", [True, False])
@pytest.mark.parametrize("stage", [AFTER_CLAIM, AFTER_WRITE, AFTER_COMMIT])
def test_killed_run_goes_on_without_loss_or_repeat(setup, path, stage, same_checkpoint):
    first = path("checkpoint")
    with pytest.raises(StreamingQueryException, match="Killed"):
        setup.run(first, kill=(stage, 1))
    finished = 2 if stage == AFTER_COMMIT else 1
    assert setup.events().filter("processed").select("range_id").distinct().count() == finished
    assert len(setup.visible()) == 20 * finished
    setup.run(first if same_checkpoint else path("other"))
    assert setup.visible() == EXPECTED
    assert range_continuity(setup.events()).count() == 0
    assert pending_ranges(setup.events()).count() == 0


def test_killed_again_while_it_replays(setup, path):
    with pytest.raises(StreamingQueryException):
        setup.run(kill=(AFTER_CLAIM, 0))
    with pytest.raises(Killed):
        setup.run(kill=(AFTER_WRITE, 0))
    setup.run()
    assert setup.visible() == EXPECTED


def test_replay_keeps_the_bounds_of_the_claim(setup):
    with pytest.raises(StreamingQueryException):
        setup.run(kill=(AFTER_WRITE, 1))
    claimed = rows(pending_ranges(setup.events()), "range_id", "partition", "from_offset", "until_offset")
    setup.spec = TopicSpec("t", root=setup.spec.root, max_files_per_trigger=3)
    setup.run()
    done = rows(setup.events().filter("processed"), "range_id", "partition", "from_offset", "until_offset")
    assert claimed and set(claimed) <= set(done)
    assert setup.visible() == EXPECTED


@pytest.mark.parametrize("files_per_batch", [1, 3, 100])
def test_result_does_not_depend_on_the_batches(spark, path, files_per_batch):
    made = Setup(spark, path, files_per_batch)
    made.publish()
    made.run(persist=True)
    made.run()
    assert made.visible() == EXPECTED
    assert rows(resume_position(made.events(), APP, "t")) == [(0, 40), (1, 25)]


def test_new_slices_after_a_restart(setup, spark):
    setup.run()
    sink = setup.sink()
    assert sink.starting_offsets(3) == "earliest"
    sink.recover(setup.spec)
    assert sink.starting_offsets(3) == '{"t": {"0": 40, "1": 25, "2": -2}}'
    publish_slice(records(spark, {0: 5}, first=40), setup.spec)
    publish_slice(records(spark, {1: 7, 2: 3}, first=25).filter("partition = 1"), setup.spec)
    setup.run()
    new = [(0, o) for o in range(40, 45)] + [(1, o) for o in range(25, 32)]
    assert setup.visible() == sorted(EXPECTED + new, key=str)
    assert range_continuity(setup.events()).count() == 0


def test_missing_offsets_stop_the_stream(spark, path):
    made = Setup(spark, path)
    publish_slice(records(spark, {0: 10}), made.spec)
    publish_slice(records(spark, {0: 10}, first=12), made.spec)
    with pytest.raises(StreamingQueryException, match="partition 0"):
        made.run()


def test_missing_offsets_inside_a_batch_stop_the_stream(spark, path):
    made = Setup(spark, path)
    publish_slice(records(spark, {0: 10}).filter("offset <> 4"), made.spec)
    with pytest.raises(StreamingQueryException, match="9 rows"):
        made.run()


def test_holes_carry_the_position_forward(spark, path):
    made = Setup(spark, path, files_per_batch=1)
    publish_slice(records(spark, {0: 10}).filter("offset <> 4"), made.spec)
    publish_slice(records(spark, {0: 10}, first=12), made.spec)
    made.run(holes=True)
    done = rows(made.events().filter("processed"), "from_offset", "until_offset", "n")
    assert done == [(0, 10, 9), (10, 22, 10)]
    assert range_continuity(made.events()).count() == 0


def test_ledger_event_fields(spark, path):
    made = Setup(spark, path, files_per_batch=100)
    made.publish()
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 6)
    made.run(run_id="r1", clock=lambda: at)
    got = made.events().select("application_id", "topic", "run_id", "event_time").distinct().collect()
    assert [tuple(r) for r in got] == [(APP, "t", "r1", at)]
    assert rows(made.events(), "partition", "processed", "n") == [
        (0, False, 40), (0, True, 40), (1, False, 25), (1, True, 25),
    ]


def test_compacted_ledger_goes_on(setup, spark, path):
    with pytest.raises(StreamingQueryException):
        setup.run(kill=(AFTER_CLAIM, 1))
    later = datetime.datetime.now() + datetime.timedelta(days=30)
    compact_ledger(spark, setup.ledger, later)
    assert pending_ranges(setup.events()).count() > 0
    setup.run()
    assert setup.visible() == EXPECTED
    compact_ledger(spark, setup.ledger, later)
    assert setup.events().filter("processed").count() == 2
    assert setup.visible() == EXPECTED


def test_unfinished_output_is_pruned(setup, spark):
    with pytest.raises(StreamingQueryException):
        setup.run(kill=(AFTER_WRITE, 1))
    plan = read_output(spark, setup.output, setup.ledger)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range_id" in plan or "PartitionFilters: [NOT (range_id" in plan
    assert "Join" not in plan
    assert len(setup.visible()) == 20


def test_output_without_a_ledger_is_refused(setup, spark, path):
    setup.run()
    with pytest.raises(ValueError):
        read_output(spark, setup.output, path("nowhere"))


def test_process_may_aggregate(setup, spark):
    setup.run(process=lambda df: df.groupBy("partition").agg(F.count("*").alias("c")))
    total = read_output(spark, setup.output, setup.ledger).agg(F.sum("c")).first()[0]
    assert total == len(EXPECTED)


def test_expired_records_of_a_claim_are_an_error(setup, spark):
    with pytest.raises(StreamingQueryException):
        setup.run(kill=(AFTER_CLAIM, 0))
    sink = setup.sink()
    kept = records(spark, {0: 40, 1: 25}).filter("offset >= 6")
    setup.spec = TopicSpec("t", root=setup.spec.root + "-expired", max_files_per_trigger=2)
    publish(kept, setup.spec, offsets_per_slice=10)
    with pytest.raises(DataLossError, match="were claimed"):
        sink.recover(setup.spec)
    assert resume_position(setup.events(), APP, "t").count() == 0


def test_a_double_does_not_hide_a_hole(spark, path):
    made = Setup(spark, path)
    twice = records(spark, {0: 4}).filter("offset <> 2")
    publish_slice(twice.unionByName(twice.filter("offset = 1")), made.spec)
    with pytest.raises(StreamingQueryException, match="4 rows with 3 offsets"):
        made.run()


def test_resumed_stream_is_pruned_to_what_is_new(setup, spark, path):
    setup.run()
    sink = setup.sink()
    sink.recover(setup.spec)
    publish(records(spark, {0: 5, 2: 3}, first=40), setup.spec, offsets_per_slice=10)
    spec = sink.resume(setup.spec)
    assert spec.positions == {0: 40, 1: 25} and spec.first_slice == 8
    query = (
        read_topic_stream(spark, spec).select("partition", "offset").writeStream.format("memory").queryName("resumed")
        .option("checkpointLocation", path("cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("resumed")) == sorted([(0, o) for o in range(40, 45)] + [(2, o) for o in range(40, 43)], key=str)
    plan = query._jsq.explainInternal(True)
    filters = plan.rpartition("PartitionFilters: ")[2]
    assert "(slice#" in filters and ">= 8)" in filters
    # Eight slices were there before; their files are not read.
    assert sum(p["numInputRows"] for p in query.recentProgress) == 8
    run_exactly_once(read_topic_stream(spark, spec), sink).awaitTermination()
    assert len(setup.visible()) == len(EXPECTED) + 8


def test_kafka_resumes_at_the_positions(setup):
    setup.run()
    sink = setup.sink()
    sink.recover(setup.spec)
    assert sink.resume(TopicSpec("t", kind="kafka"), 2).starting_offsets == '{"t": {"0": 40, "1": 25}}'
    with pytest.raises(ValueError):
        sink.resume(TopicSpec("t", kind="kafka"))


def test_of_two_writers_one_is_refused_at_its_claim(setup, spark):
    first, second = setup.sink(), setup.sink()
    first.recover(setup.spec)
    second.recover(setup.spec)
    batch = records(spark, {0: 5, 1: 3})
    # The second one comes between the claim of the first and its output.
    errors = []

    def meanwhile(stage, batch_id):
        if stage == AFTER_CLAIM:
            with pytest.raises(ClaimRefusedError, match=first.run_id):
                second(batch, 0)
            errors.append(stage)

    first.on_stage = meanwhile
    first(batch, 0)
    assert errors == [AFTER_CLAIM]
    assert len(setup.visible()) == 8 and len(set(setup.visible())) == 8
    # It is refused as long as it goes on from old positions.
    with pytest.raises(ClaimRefusedError):
        second(records(spark, {0: 7}), 1)
    first.on_stage = lambda stage, batch_id: None
    first(records(spark, {0: 2}, first=5), 1)
    assert len(setup.visible()) == 10


def test_writers_that_race_give_each_record_once(setup):
    sinks = [setup.sink(), setup.sink()]
    for sink in sinks:
        sink.recover(setup.spec)
    batch = records(setup.spark, {0: 40, 1: 25})

    def work(sink):
        try:
            sink(batch, 0)
            return "done"
        except ClaimRefusedError:
            return "refused"

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(work, sinks)) == ["done", "refused"]
    assert setup.visible() == EXPECTED


def test_a_claim_that_never_reached_the_ledger_is_finished(setup, monkeypatch):
    sink = setup.sink()
    sink.recover(setup.spec)

    def lost(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(sink, "_append_events", lost)
    with pytest.raises(OSError):
        sink(records(sink.spark, {0: 10, 1: 5}), 0)
    other = setup.sink()
    other.recover(setup.spec)
    assert other.positions == {0: 10, 1: 5} and len(setup.visible()) == 15
    setup.run()
    assert setup.visible() == EXPECTED


def test_compaction_drops_old_claims(setup, path):
    setup.run()
    folder = f"{path('ledger')}/claims"
    n = len([f for f in os.listdir(folder) if f.endswith(".json")])
    assert n > 0
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    compact_ledger(setup.spark, path("ledger"), now)
    assert len([f for f in os.listdir(folder) if f.endswith(".json")]) == n
    compact_ledger(setup.spark, path("ledger"), now + datetime.timedelta(days=30))
    assert [f for f in os.listdir(folder) if f.endswith(".json")] == []
