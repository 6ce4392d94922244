"""Streams with state of their own."""

import json
import time

from quillmesh.streaming import ledger

SCHEMA = "run_id string, occurred_at timestamp, final_result string"


def test_progress_of_runs_over_batches_and_a_restart(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    numbers = iter(range(100))

    def put(*rows):
        lines = [json.dumps({"run_id": run, "occurred_at": f"2024-01-01T00:00:{second:02d}", "final_result": result}) for run, second, result in rows]
        (source / f"{next(numbers)}.json").write_text("\n".join(lines))

    def run():  # each call is a restart from the checkpoint
        seen.clear()
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(source))
        snapshots = ledger.run_progress(stream, idle_ms=2000)
        with ledger.without_empty_batches(spark):
            query = snapshots.writeStream.foreachBatch(lambda rows, batch: seen.extend(map(tuple, rows.collect()))).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
        return sorted(seen)

    put(("a", 0, "SUCCESS"), ("a", 10, "TIMEOUT"), ("b", 5, "SUCCESS"))
    assert run() == [("a", 2, 1, 10.0, 0.2, "running"), ("b", 1, 1, 0.0, None, "running")]
    put(("a", 20, "SUCCESS"))
    put(("a", 15, "SUCCESS"), ("a", 16, "COMPLETED"))
    got = run()
    assert [r for r in got if r[0] == "a"] == [("a", 3, 2, 20.0, 0.15, "running"), ("a", 4, 3, 20.0, 0.2, "final")]
    time.sleep(2.5)
    put(("c", 1, "SUCCESS"))
    got = run()
    # b fell silent; a was over, and would begin anew
    assert ("c", 1, 1, 0.0, None, "running") in got and [r for r in got if r[0] == "a"] == []
    put(("a", 1, "SUCCESS"))
    every = got + run()
    assert [r for r in every if r[0] == "b"] in ([("b", 1, 1, 0.0, None, "interrupted")], []) and ("a", 1, 1, 0.0, None, "running") in every
