"""Answers that land in a folder: read once, also after a run that died, and rejected ones kept apart."""

from __future__ import annotations

import datetime

import pytest

from conftest import rows
from test_reports import METADATA
from wardline import schemas
from wardline.plans import landing, tagging

DAY = datetime.datetime(2024, 1, 1)


def tags(*names):
    listed = ", ".join(f'"{name}"' for name in names)
    return '{"tag_assignments": [{"tags": [%s]}]}' % listed


@pytest.fixture
def job(spark, tmp_path):
    metadata = {n: spark.createDataFrame(d, schemas.METADATA[n]) for n, d in METADATA.items()}
    table, folder, landed = "landed_tags", str(tmp_path / "tags"), str(tmp_path / "landing")

    class Job:
        def land(self, day, *answers):
            at = DAY + datetime.timedelta(days=day)
            found = [(name, code, payload, at) for name, code, payload in answers]
            df = spark.createDataFrame(found, schemas.LANDED_ANSWER)
            df.coalesce(1).write.mode("append").parquet(landed)

        def run(self, **options):
            landing.refresh_from_landing(spark, table, folder, landed, metadata, **options)
            return self.table()

        def table(self):
            stored = spark.read.table(table).selectExpr("identifier", "tags", "day(lastCheckedAt)")
            return rows(stored)

        def rejected(self):
            return rows(landing.rejected_answers(spark, folder).select("identifier", "reason", "payload"))

    yield Job()
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_each_file_is_read_once(job, monkeypatch):
    merged = []
    plain = landing.merge_batch

    def counted(spark, table, folder, answers, *rest):
        merged.append(answers.count())
        return plain(spark, table, folder, answers, *rest)

    monkeypatch.setattr(landing, "merge_batch", counted)
    job.land(1, ("c", 200, tags("x")), ("c.s.t", 200, tags("x", "y")))
    assert job.run() == [("c", ["x"], 2), ("c.s.t", ["x", "y"], 2)]
    job.land(2, ("c", 200, tags("z")))
    job.land(3, ("c", 200, tags("w")), ("elsewhere", 200, tags("x")))
    # Of answers in one batch the one that landed last counts.
    assert job.run() == [("c", ["w"], 2), ("c.s.t", ["x", "y"], 2)]
    assert job.run() == [("c", ["w"], 2), ("c.s.t", ["x", "y"], 2)]
    assert merged == [2, 3]


def test_batches_of_one_file_give_the_same_table(job):
    for day in range(4):
        job.land(day, ("c", 200, tags(f"x{day}")), ("c.s", 200, tags("y")))
    assert job.run(files_per_batch=1, buckets=2) == [("c", ["x3"], 1), ("c.s", ["y"], 1)]


@pytest.mark.parametrize("after", [False, True])
def test_a_run_that_died_is_started_again(job, monkeypatch, after):
    """It dies before the version of its batch is published, or behind that but before the batch counts as read."""
    job.land(1, ("c", 200, tags("x")))
    job.run()
    job.land(2, ("c", 200, tags("y")), ("c.s", 200, tags("new")), ("c.s.t", 500, None))
    plain = tagging.publish_version

    def dies(*args, **options):
        if after:
            plain(*args, **options)
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(tagging, "publish_version", dies)
        with pytest.raises(Exception, match="killed"):
            job.run()
    expected = [("c", ["y"], 2), ("c.s", ["new"], 3)]
    assert (job.table() == expected) is after
    assert job.run() == expected
    assert job.rejected() == [("c.s.t", "status 500", None)]


def test_rows_in_are_rows_read_and_rows_rejected(spark, job):
    answers = [
        ("c", 200, tags("x")),
        ("c.s", 200, '{"tag_assignments": []}'),
        ("c.s.t", 200, '{"tag_assignments": [{"tags": ["x"'),
        ("d", 200, '{"tag_assignments": 5}'),
        ("e", 500, "service unavailable"),
        ("f", None, tags("x")),
        ("g", 200, None),
        ("h", 200, ""),
        (None, 200, tags("x")),
        ("i", 200, "{}"),
        ("j", 200, '{"tag_assignments": [{}, {"tags": ["later"]}]}'),
        ("c", 404, "not found"),
    ]
    job.land(1, *answers)
    assert job.run() == [("c", ["x"], 2)]
    rejected = job.rejected()
    assert rejected == sorted(
        [
            ("c.s.t", "malformed", '{"tag_assignments": [{"tags": ["x"'),
            ("d", "malformed", '{"tag_assignments": 5}'),
            ("e", "status 500", "service unavailable"),
            ("f", "status unknown", tags("x")),
            ("g", "no answer", None),
            ("h", "no answer", ""),
            ("c", "status 404", "not found"),
        ],
        key=repr,
    )
