"""Model calls at a bounded rate: slots, retries, restarts."""

import json
import os

import pytest
from pyspark.sql import types as T

from hiremill.operators import pacing
from hiremill.operators.pacing import Lane, answer_slices, calls_in_slots, lay_out_prompts, paced_answers

KEY = T.StructField("batch_id", T.LongType())


class Clock:
    def __init__(self, lag=0.0):
        self.now, self.lag = 100.0, lag

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds + self.lag


@pytest.mark.parametrize("lag", [0.0, 0.3])
def test_lanes_never_share_a_slot(lag):
    slots = []
    for number in range(3):
        clock = Clock(lag)
        lane = Lane(0.5, 3, number, clock, clock.sleep)
        for i in range(20):
            at = lane.turn(2.0 if i == 7 else 0.0)
            assert int(at // 0.5) % 3 == number
            slots.append(int(at // 0.5))
            clock.now += 0.1 * (i % 9)
    assert len(set(slots)) == 60


def test_a_retry_waits():
    clock = Clock()
    lane = Lane(0.5, 1, 0, clock, clock.sleep)
    first = lane.turn()
    assert lane.turn(5.0) >= first + 5.0


def flaky(folder):
    """Answers at the second call of a prompt; leaves a file for each call."""

    def model(prompt):
        name = prompt.split()[-1]
        calls = len([f for f in os.listdir(folder) if f.startswith(f"{name}-")])
        open(f"{folder}/{name}-{calls}", "w").close()
        if calls == 0 and int(name) % 2:
            raise TimeoutError("busy")
        return json.dumps({name: "x"}), 3

    return model


def prompts(spark, ids):
    return spark.createDataFrame([(i, f"tag {i}") for i in ids], "batch_id long, prompt string")


def test_calls_keep_to_the_rate_and_no_answer_is_paid_twice(spark, tmp_path):
    root, calls = str(tmp_path), str(tmp_path / "calls")
    os.mkdir(calls)

    def run():
        answer_slices(spark, f"{root}/p", f"{root}/a", f"{root}/c", flaky(calls), lambda x: isinstance(x, dict), KEY, rpm=3000, lanes=2, retry_wait=0.05).awaitTermination()

    lay_out_prompts(prompts(spark, range(10)).coalesce(1), f"{root}/p", 4)
    run()
    lay_out_prompts(prompts(spark, range(5, 15)).coalesce(1), f"{root}/p", 4)  # some again
    run()
    run()
    log = spark.read.parquet(f"{root}/a")
    rows = {r.batch_id: r for r in log.collect()}
    assert log.count() == 15 and all((r.attempts, r.tokens, r.error) == (1 + i % 2, 3, None) for i, r in rows.items())
    assert sorted(os.listdir(calls)) == sorted([f"{i}-0" for i in range(15)] + [f"{i}-1" for i in range(15) if i % 2])
    assert tuple(calls_in_slots(log, 3000).first()) == (22, 1)
    assert all(r.called_at[1] - r.called_at[0] >= 0.05 for i, r in rows.items() if i % 2)


def test_answers_committed_before_a_loss_are_not_asked_again(spark, tmp_path, monkeypatch):
    root, calls = str(tmp_path), str(tmp_path / "calls")
    os.mkdir(calls)
    lay_out_prompts(prompts(spark, [0, 2, 4, 6]).coalesce(1), f"{root}/p", 2)
    asked, real = [], paced_answers

    def dies_after_one(*args, **kw):
        asked.append(1)
        if len(asked) == 2:
            raise OSError("lost")
        return real(*args, **kw)

    def run():
        answer_slices(spark, f"{root}/p", f"{root}/a", f"{root}/c", flaky(calls), lambda x: isinstance(x, dict), KEY, rpm=6000).awaitTermination()

    with monkeypatch.context() as m:
        m.setattr(pacing, "paced_answers", dies_after_one)
        with pytest.raises(Exception, match="lost"):
            run()
    assert spark.read.parquet(f"{root}/a").count() == 2
    run()
    assert spark.read.parquet(f"{root}/a").count() == 4 and len(os.listdir(calls)) == 4


def test_failures_are_logged_and_empty_prompts_make_no_call(spark):
    def down(prompt):
        raise TimeoutError("down")

    (row,) = paced_answers(prompts(spark, [1]), down, bool, "batch_id", 6000, 2, 0.0).collect()
    assert (row.attempts, row.tokens, row.answer, len(row.called_at)) == (3, 0, None, 3) and "down" in row.error
    assert paced_answers(prompts(spark, [1]).limit(0), down, bool, "batch_id", 6000, 2).collect() == []


def test_a_lane_goes_on_while_a_failed_prompt_waits():
    clock, tries = Clock(), {}

    def model(prompt):
        tries[prompt] = tries.get(prompt, 0) + 1
        if prompt == "a" and tries[prompt] < 3:
            raise TimeoutError("busy")
        return "{}", 1

    lane = Lane(0.5, 2, 0, clock, clock.sleep)
    rows = list(pacing.lane_answers(lane, iter([(n, n) for n in "abcdefgh"]), model, lambda x: isinstance(x, dict), 2.0))
    assert sorted(r[0] for r in rows) == list("abcdefgh") and {r[0]: r[1] for r in rows}["a"] == 3
    slots = sorted(int(t // 0.5) for r in rows for t in r[5])
    # Ten calls, a turn each second: without a pause but for those of the last tries.
    assert len(set(slots)) == 10 and all(s % 2 == 0 for s in slots) and slots[-1] - slots[0] == 18
    of_a = next(r[5] for r in rows if r[0] == "a")
    assert all(y - x >= 2.0 for x, y in zip(of_a, of_a[1:]))


def test_answers_are_read_once_for_all_new_slices(spark, tmp_path, monkeypatch):
    root, reads, slices = str(tmp_path), [], []
    real_in, real_paced = pacing.answers_in, paced_answers
    monkeypatch.setattr(pacing, "answers_in", lambda *a: (reads.append(1), real_in(*a))[1])
    monkeypatch.setattr(pacing, "paced_answers", lambda *a: (slices.append(a[0].count()), real_paced(*a))[1])

    def run():
        model = lambda prompt: ("{}", 1)
        answer_slices(spark, f"{root}/p", f"{root}/a", f"{root}/c", model, lambda x: isinstance(x, dict), KEY, rpm=60000).awaitTermination()

    # A key in two files is asked once; without a key each stands for itself.
    for ids in ([1, 2, 3], [3, 4, None], [None, 5, 5]):
        lay_out_prompts(prompts(spark, ids).coalesce(1), f"{root}/p", 50)
    run()
    assert len(reads) == 1 and sorted(slices) == [2, 3, 3]
    log = [r.batch_id for r in spark.read.parquet(f"{root}/a").collect()]
    assert sorted(x for x in log if x is not None) == [1, 2, 3, 4, 5, 5] and log.count(None) == 2
    lay_out_prompts(prompts(spark, [1, 2]).coalesce(1), f"{root}/p", 50)
    run()
    assert spark.read.parquet(f"{root}/a").count() == 8
