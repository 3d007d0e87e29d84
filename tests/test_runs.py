from datetime import datetime

import pytest

from tarnkeep.operators.runs import (
    as_run_log,
    sync_final_state,
    sync_latest_status,
    sync_outcomes,
)
from tarnkeep.plans.sync_log import log_sync, sync_log, sync_targets
from tarnkeep.sinks.log_tables import append_log

RUN_TS = datetime(2024, 5, 1, 12)
POLLS = (
    "endpoint_id int, batch_id string, poll_ts timestamp_ntz, poll_no long, "
    "ok boolean, body string"
)


def polls(spark, rows):
    """(endpoint, batch, minute, ok, body); the position settles equal minutes."""
    return spark.createDataFrame(
        [(e, b, datetime(2024, 5, 1, 12, m), n, ok, t) for n, (e, b, m, ok, t) in enumerate(rows)],
        POLLS,
    )


def responses(spark, rows):
    return spark.createDataFrame(
        rows, "endpoint_id int, http_status int, body string, error string"
    )


@pytest.mark.parametrize(
    "seen, expected",
    [
        ([(True, '{"progressState": "inProgress"}'), (True, '{"progressState": "success"}')],
         "success"),
        ([(False, "busy"), (True, '{"progressState": "success"}')], "ERROR_FETCHING_STATUS"),
        ([(False, None)], "ERROR_FETCHING_STATUS"),
        ([(True, "{}"), (True, '{"progressState": "success"}')], "unknown"),
        ([(True, '{"progressState": null}')], None),
        ([(True, "<html>")], "ERROR: not a JSON object: <html>"),
        ([(True, None)], "ERROR: not a JSON object: no body"),
        ([(True, "[1]")], "ERROR: not a JSON object: [1]"),
        ([(True, '{"progressState": "success"} x')],
         'ERROR: not a JSON object: {"progressState": "success"} x'),
        ([(True, '{"progressState": "a", "progressState": "b"}')], "b"),
        ([(True, "{'progressState': 'a'}")], "ERROR: not a JSON object: {'progressState': 'a'}"),
    ],
)
def test_final_state(spark, seen, expected):
    rows = [(1, "b", minute, ok, body) for minute, (ok, body) in enumerate(seen)]
    got = sync_final_state(polls(spark, rows)).collect()
    assert [(row.endpoint_id, row.batch_id, row.final_state) for row in got] == [
        (1, "b", expected)
    ]


def test_a_running_batch_has_no_final_state(spark):
    rows = [(1, "b", minute, True, '{"progressState": "inProgress"}') for minute in range(3)]
    assert sync_final_state(polls(spark, rows)).count() == 0


def test_equal_poll_times_go_by_number(spark):
    bodies = ['{"progressState": "z"}', '{"progressState": "a"}']
    rows = [(1, "b", 5, True, body) for body in bodies]
    assert sync_final_state(polls(spark, rows)).first().final_state == "z"


REPLIES = [
    (1, 200, '{"batchId": "x"}', None),
    (2, 400, '{"batchId": "x"}', None),
    (3, 409, "busy", None),
    (4, 202, "{}", None),
    (5, 200, "<html>no</html>", None),
    (6, None, None, "connection refused " * 5),
    (7, 500, '{"batchId": 7}', None),
    (8, 200, '{"batchId": null}', None),
    (9, 200, "null", None),
    (10, 200, '{"batchId": "running"}', None),
]


def test_outcomes(spark):
    ends = sync_final_state(
        polls(
            spark,
            [
                (1, "x", 1, True, '{"progressState": "success"}'),
                (1, "other", 0, True, '{"progressState": "failure"}'),
                (4, "NO_ID", 1, True, "{}"),
                (7, "7", 1, False, None),
                (8, None, 1, True, '{"progressState": "success"}'),
            ],
        )
    )
    got = sync_outcomes(responses(spark, REPLIES), ends).collect()
    assert {row.endpoint_id: (row.status, row.batch_id, row.finished) for row in got} == {
        1: ("success", "x", True),
        2: ("FAILED_ALREADY_RUNNING", "N/A", True),
        3: ("FAILED_ALREADY_RUNNING", "N/A", True),
        4: ("unknown", "NO_ID", True),
        5: ("ERROR: not a JSON object: <html>no</html>", "N/A", True),
        6: ("ERROR: " + ("connection refused " * 5)[:50], "N/A", True),
        7: ("ERROR_FETCHING_STATUS", "7", True),
        8: ("success", None, True),
        9: ("ERROR: not a JSON object: null", "N/A", True),
        10: (None, "running", False),
    }


@pytest.fixture
def targets(spark):
    workspaces = spark.createDataFrame(
        [(1, "WS_A_dev"), (2, "WS_B_dev")], "workspace_id int, workspace_name string"
    )
    items = spark.createDataFrame(
        [
            (1, 1, "SQLEndpoint", "LH_one_a"),
            (1, 10, "SQLEndpoint", "LH_ten_a"),
            (1, 3, "Warehouse", "LH_three_a"),
            (2, 2, "SQLEndpoint", "LH_two_a"),
        ],
        "workspace_id int, item_id int, item_type string, item_name string",
    )
    return sync_targets(workspaces, items, ["A"], "_dev")


def test_log_rows(spark, targets):
    seen = polls(spark, [(1, "x", 1, True, '{"progressState": "success"}')])
    log = sync_log(targets, RUN_TS, responses(spark, REPLIES), seen)
    assert log.dtypes == [
        ("ExecutionTime", "timestamp_ntz"),
        ("WorkspaceName", "string"),
        ("EndpointName", "string"),
        ("Status", "string"),
        ("BatchId", "string"),
        ("IsDryRun", "boolean"),
    ]
    rows = {tuple(row)[1:] for row in log.collect()}
    assert rows == {
        ("WS_A_dev", "LH_one_a", "Starting", "N/A", False),
        ("WS_A_dev", "LH_one_a", "success", "x", False),
        ("WS_A_dev", "LH_ten_a", "Starting", "N/A", False),
    }
    latest = {row.EndpointName: row.Status for row in sync_latest_status(log).collect()}
    assert latest == {"LH_one_a": "success", "LH_ten_a": "Starting"}


def test_dry_run(targets):
    rows = sync_log(targets, RUN_TS, dry_run=True).collect()
    assert len(rows) == 4
    assert {row.Status for row in rows} == {"Starting", "DRY_RUN_SUCCESS"}
    assert {row.ExecutionTime for row in rows} == {RUN_TS}
    assert all(row.IsDryRun and row.BatchId == "N/A" for row in rows)


def test_logging_is_optional(spark, targets, tmp_path):
    rows = sync_log(targets, RUN_TS, dry_run=True)
    log_sync(rows, None)
    log_sync(rows, lambda frame: append_log(frame, "parquet", path=str(tmp_path / "log")))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4


def test_no_targets_no_rows(targets):
    assert sync_log(targets.limit(0), RUN_TS, dry_run=True).count() == 0


def test_a_later_run_beats_an_outcome(spark):
    rows = [
        (datetime(2024, 5, 1), "w", "e", "success", "b", False),
        (datetime(2024, 5, 2), "w", "e", "Starting", "N/A", False),
    ]
    log = spark.createDataFrame(
        rows,
        "ExecutionTime timestamp_ntz, WorkspaceName string, EndpointName string, "
        "Status string, BatchId string, IsDryRun boolean",
    )
    assert sync_latest_status(log).first().Status == "Starting"


def test_entries_with_number_flags(spark):
    entries = spark.createDataFrame(
        [{"ExecutionTime": RUN_TS, "WorkspaceName": "w", "EndpointName": "e",
          "Status": "Starting", "BatchId": "N/A", "IsDryRun": 1}]
    )
    row = as_run_log(entries).first()
    assert (row.IsDryRun, row.ExecutionTime) == (True, RUN_TS)
