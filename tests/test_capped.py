import pytest

from tests.conftest import rows
from tests.test_topics import positions, records
from tidelog.sources.capped import run_capped, shares
from tidelog.sources.topics import TopicSpec, publish
from tidelog.streaming.exactly_once import ExactlyOnceSink, read_output


def test_shares():
    assert shares({0: 5, 1: 5}, 100) == {0: 5, 1: 5}
    assert shares({0: 30, 1: 10}, 20) == {0: 15, 1: 5}
    assert sum(shares({0: 7, 1: 7, 2: 7}, 10).values()) == 10
    assert shares({0: 1000, 1: 1}, 1) == {0: 1, 1: 0}
    assert shares({}, 5) == {}


def test_no_batch_has_more_records_than_the_cap(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 40, 1: 13}), spec, offsets_per_slice=10)
    seen = []

    def keep(batch, batch_id):
        seen.append([tuple(r) for r in batch.select("partition", "offset").collect()])

    query = run_capped(spark, spec, 15, keep)
    assert not query.isActive
    assert all(0 < len(batch) <= 15 for batch in seen) and len(seen) == 4
    assert sorted(r for batch in seen for r in batch) == sorted([(0, o) for o in range(40)] + [(1, o) for o in range(13)])
    # Ranges of a partition follow one another, whatever slices they meet.
    for p in (0, 1):
        order = [o for batch in seen for q, o in sorted(batch) if q == p]
        assert order == list(range(len(order)))


def test_a_stream_goes_on_from_positions_and_sees_new_slices(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 20}), spec, offsets_per_slice=7)
    sink = ExactlyOnceSink(spark, application_id="a", topic="t", ledger_path=path("ledger"), output_path=path("out"),
                           process=lambda df: df.select("partition", "offset"))
    sink.recover(spec)
    run_capped(spark, spec, 8, sink, positions=sink.positions)
    assert sink.positions == {0: 20}
    publish(records(spark, {0: 5, 1: 30}, first=20).filter("partition = 0 OR offset >= 20"), spec, offsets_per_slice=7)
    again = ExactlyOnceSink(spark, application_id="a", topic="t", ledger_path=path("ledger"), output_path=path("out"),
                            process=lambda df: df.select("partition", "offset"))
    again.recover(spec)
    run_capped(spark, spec, 8, again, positions={**again.positions, 1: 20})
    visible = rows(read_output(spark, path("out"), path("ledger")), "partition", "offset")
    assert visible == sorted([(0, o) for o in range(25)] + [(1, o) for o in range(20, 50)], key=str)


def test_an_error_in_the_function_ends_the_query(spark, path):
    spec = TopicSpec("t", root=path("topic"))
    publish(records(spark, {0: 5}), spec, offsets_per_slice=10)

    def broken(batch, batch_id):
        raise ValueError("broken")

    with pytest.raises(Exception, match="broken"):
        run_capped(spark, spec, 2, broken)
    with pytest.raises(ValueError):
        run_capped(spark, spec, 0, broken)


def test_an_empty_topic_ends_at_once(spark, path):
    run_capped(spark, TopicSpec("none", root=path("topic")), 3, lambda batch, batch_id: None)
    assert positions(records(spark, {0: 0})) == []
