"""The whole job on files, its records, and resumption."""

from __future__ import annotations

import glob

import pytest

from factprep.contract import TRIPS
from factprep.operators import runlog
from factprep.plans import prepare as P
from factprep.session import literal_path
from factprep.sources import inventory
from factprep.sources.fact import read_bucketed
from factprep.sources.sinks import committed, exists
from factprep.streaming.staging import stage_available


def test_direct_and_staged_runs_agree(spark, trips, tmp_path):
    runs = str(tmp_path / "runs")
    direct = P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/direct", buckets=4, runs=runs, run_id="direct")
    staged = P.prepare(
        spark,
        trips.folder,
        trips.zones,
        f"{tmp_path}/staged",
        staging=f"{tmp_path}/staging",
        buckets=4,
        runs=runs,
        run_id="staged",
        framework="other",
    )
    resumed = P.prepare(
        spark,
        trips.folder,
        trips.zones,
        f"{tmp_path}/resumed",
        reuse_staging=f"{tmp_path}/staging",
        buckets=4,
        runs=runs,
        run_id="resumed",
    )
    assert (direct.raw_rows, direct.cleaned_rows, direct.output_rows) == (trips.raw, None, trips.output)
    assert (staged.raw_rows, staged.cleaned_rows, staged.output_rows) == (trips.raw, trips.clean, trips.output)
    assert (resumed.cleaned_rows, resumed.output_rows) == (trips.clean, trips.output)

    recorded = runlog.read(spark, runs)
    assert recorded.count() == 6
    newest = runlog.latest(recorded).cache()
    assert {r.run_id: r.status for r in newest.collect()} == dict.fromkeys(("direct", "staged", "resumed"), "complete")
    pair = newest.where("run_id IN ('direct', 'staged')")
    assert runlog.comparable(pair).count() == 0
    found = P.compare(spark, direct.output, staged.output, runs=pair)
    assert found == {"exact_match": True, "bucket_count": 4, "left_rows": 4, "right_rows": 4}
    # A resumed run did not do all of the work and does not count as a benchmark.
    assert [r.reason for r in runlog.comparable(newest).collect()] == ["not_eligible"]
    assert P.compare(spark, staged.output, resumed.output, runs=newest.where("run_id <> 'direct'"))["left_rows"] == 4
    runlog.require_profileable(newest.where("run_id = 'direct'"))
    rows = {r.run_id: r for r in newest.collect()}
    assert {r.block_mib for r in rows.values()} == {128} and rows["direct"].executors == 1
    assert (rows["direct"].staged_files, rows["direct"].buckets_over_limit) == (None, 0)
    assert rows["staged"].staged_files == len(glob.glob(f"{tmp_path}/staging/*/*.parquet"))
    assert 0 < rows["staged"].largest_bucket_rows <= trips.clean and "staging included" in rows["staged"].timing_boundary
    listed = spark.read.parquet(runlog.manifest_path(runs))
    assert {(r.run_id, r.row_count) for r in listed.collect()} == {
        (run, n) for run in rows for n in (len(trips.first_rows), len(trips.second_rows))
    }
    # One output under the records of two runs, and records of other outputs.
    with pytest.raises(ValueError, match="not those of the two outputs"):
        P.compare(spark, direct.output, resumed.output, runs=pair)
    with pytest.raises(ValueError, match="with itself"):
        P.compare(spark, direct.output, f"{direct.output}/", runs=pair)
    with pytest.raises(ValueError, match="recorded with 4 buckets"):
        P.compare(spark, direct.output, staged.output, runs=pair, buckets=8)
    changed = pair.selectExpr("* EXCEPT (output_rows)", "output_rows + 1 AS output_rows")
    with pytest.raises(ValueError, match="recorded number"):
        P.compare(spark, direct.output, staged.output, runs=changed)
    summary = {r.framework: r for r in runlog.summarize(pair).collect()}
    assert summary["other"].trials == 1 and summary["other"].below_median == 0


def test_output_files(spark, trips, tmp_path):
    out = f"{tmp_path}/out"
    done = P.prepare(spark, trips.folder, trips.zones, out)
    assert done.buckets == 128
    assert glob.glob(f"{out}/bucket=*/*.snappy.parquet")
    df = read_bucketed(spark, out, "bucket")
    assert df.drop("bucket").schema == TRIPS.output_schema()
    for path in glob.glob(f"{out}/bucket=*/*.parquet"):
        import pyarrow.parquet as pq

        types = {f.name: str(f.type) for f in pq.ParquetFile(path).schema_arrow}
        assert list(types) == TRIPS.output_columns
        assert types["tpep_pickup_datetime"] == "timestamp[us]" and types["pickup_hour"] == "int64"


def test_prefix_runs(spark, trips, tmp_path):
    size = inventory.file_inventory(spark, trips.first).first().uncompressed_bytes
    by_count = P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/a", max_files=1, buckets=4)
    by_size = P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/b", max_uncompressed_gb=size / 1e9, buckets=4)
    assert by_count.raw_rows == by_size.raw_rows == len(trips.first_rows)
    assert by_count.output_rows == by_size.output_rows == 3
    with pytest.raises(ValueError, match="not both"):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/c", max_files=1, max_uncompressed_gb=1.0)


def test_refusals_leave_nothing_behind(spark, trips, tmp_path):
    there = tmp_path / "there"
    there.mkdir()
    with pytest.raises(FileExistsError):
        P.prepare(spark, trips.folder, trips.zones, str(there), staging=f"{tmp_path}/staging")
    with pytest.raises(FileNotFoundError):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/out", reuse_staging=f"{tmp_path}/staging")
    with open(trips.zones, "a") as zones:
        zones.write("4,East,Another zone,x\n")
    with pytest.raises(ValueError, match="id_repeated"):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/out", staging=f"{tmp_path}/staging")
    assert not (tmp_path / "staging").exists() and not (tmp_path / "out").exists()


def test_output_must_not_lie_in_reused_staging(spark, trips, tmp_path):
    staging = f"{tmp_path}/staging"
    P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/a", staging=staging, buckets=4)
    for inside in (f"{staging}/out", f"{tmp_path}/other/../staging/out"):
        with pytest.raises(ValueError, match="overlaps"):
            P.prepare(spark, trips.folder, trips.zones, inside, reuse_staging=staging, buckets=4)
    with pytest.raises(ValueError, match="overlaps"):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/runs/out", runs=f"{tmp_path}/runs")
    assert P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/b", reuse_staging=staging, buckets=4).output_rows == 4


def test_foreign_staging_is_refused(spark, trips, tmp_path):
    staging = f"{tmp_path}/staging"
    P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/a", staging=staging, buckets=4)
    with pytest.raises(ValueError, match="another input"):
        P.prepare(spark, trips.second, trips.zones, f"{tmp_path}/b", reuse_staging=staging, buckets=4)
    (tmp_path / "bare").mkdir()
    with pytest.raises(ValueError, match="Nothing says"):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/b", reuse_staging=f"{tmp_path}/bare", buckets=4)


def test_buckets_over_the_limit(spark, trips, tmp_path):
    runs = str(tmp_path / "runs")
    sizes = dict(buckets=1, bucket_bytes=512 * 3, runs=runs)
    done = P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/a", run_id="a", **sizes)
    row = runlog.latest(runlog.read(spark, runs)).first()
    assert (row.buckets_over_limit, row.largest_bucket_rows, row.bucket_bytes) == (1, done.output_rows, 1536)
    with pytest.raises(ValueError, match="1 buckets are over the limit; the largest has 8 rows"):
        P.prepare(
            spark, trips.folder, trips.zones, f"{tmp_path}/b", staging=f"{tmp_path}/s", oversized="raise", run_id="b", **sizes
        )
    assert not (tmp_path / "b").exists()
    failed = runlog.latest(runlog.read(spark, runs)).where("run_id = 'b'").first()
    assert failed.status == "failed" and "over the limit" in failed.error


def test_dimension_in_several_files(spark, trips, tmp_path):
    header, *lines = open(trips.zones).read().splitlines()
    (tmp_path / "dim").mkdir()
    for i, line in enumerate(lines):
        (tmp_path / "dim" / f"{i}.csv").write_text(f"{header}\n{line}\n")
    assert P.prepare(spark, trips.folder, f"{tmp_path}/dim", f"{tmp_path}/out", buckets=4).output_rows == trips.output


def test_failed_run_is_recorded(spark, trips, tmp_path, monkeypatch):
    def fail(*_):
        raise RuntimeError("disk full " * 500)

    monkeypatch.setattr(P, "finish", fail)
    runs = str(tmp_path / "runs")
    with pytest.raises(RuntimeError):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/out", runs=runs, run_id="r")
    row = runlog.latest(runlog.read(spark, runs)).first()
    assert (row.status, row.error) == ("failed", "disk full " * 500)
    with pytest.raises(ValueError, match="complete run"):
        runlog.require_profileable(runlog.latest(runlog.read(spark, runs)))
    with pytest.raises(ValueError, match="Unknown run fields"):
        runlog.record(spark, runs, colour="red")


def test_stream_resumes_and_never_repeats(spark, trips, tmp_path):
    source, staging, progress = tmp_path / "source", str(tmp_path / "staging"), str(tmp_path / "progress")
    source.mkdir()

    def stage():
        stage_available(spark, str(source), staging, progress, TRIPS, 8, files_per_batch=1)
        return spark.read.parquet(staging).count()

    for name in ("a", "b", "c"):
        (source / f"{name}.parquet").write_bytes(open(trips.second, "rb").read())
    assert stage() == 12
    assert stage() == 12
    (source / "d.parquet").write_bytes(open(trips.second, "rb").read())
    assert stage() == 16
    assert len(glob.glob(f"{staging}/_batch=*")) == 4
    assert spark.read.parquet(staging).select(*TRIPS.columns).distinct().count() == 4


def test_streams_of_several_sources_share_staging(spark, trips, tmp_path):
    staging = str(tmp_path / "staging")
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.parquet").write_bytes(open(trips.second, "rb").read())
        (tmp_path / name / "notes.txt").write_text("not parquet")
        stage_available(spark, str(tmp_path / name), staging, f"{tmp_path}/progress-{name}", TRIPS, 8)
    assert spark.read.parquet(staging).count() == 8


def test_stream_takes_files_by_their_own_types(spark, trips, tmp_path):
    """The two files differ in types; a third lacks a column and stops the stream before its batch."""
    source, staging, progress = tmp_path / "source", str(tmp_path / "staging"), str(tmp_path / "progress")
    (source / "deeper").mkdir(parents=True)
    (source / "a.parquet").write_bytes(open(trips.first, "rb").read())
    (source / "deeper" / "b[1].parquet").write_bytes(open(trips.second, "rb").read())
    P.stage_stream(spark, str(source), staging, progress, buckets=4)
    read = read_bucketed(spark, staging)
    assert read.select(*TRIPS.columns).schema == TRIPS.clean_schema()
    assert read.count() == trips.clean
    done = P.prepare(spark, str(source), trips.zones, f"{tmp_path}/out", buckets=4, reuse_staging=staging)
    assert done.output_rows == trips.output
    spark.range(3).write.parquet(str(source / "c"))
    with pytest.raises(Exception, match="lacks columns"):
        stage_available(spark, str(source), staging, progress, TRIPS, 4)
    assert read_bucketed(spark, staging).count() == trips.clean


def test_refused_output_leaves_nothing(spark, trips, tmp_path):
    """Without staging the guard counts what was written, before it appears."""
    base = tmp_path / "base"
    sizes = dict(buckets=1, bucket_bytes=1536, oversized="raise")
    with pytest.raises(ValueError, match="over the limit"):
        P.prepare(spark, trips.folder, trips.zones, f"{base}/out", **sizes)
    assert list(base.iterdir()) == []
    assert P.prepare(spark, trips.folder, trips.zones, f"{base}/out", buckets=1).output_rows == trips.output
    assert [p.name for p in base.iterdir()] == ["out"]


def test_only_finished_folders_appear(spark, tmp_path):
    target = str(tmp_path / "deep" / "out[1]")
    with pytest.raises(KeyboardInterrupt):
        with committed(spark, target) as place:
            spark.range(5).write.parquet(place)
            # What a killed run leaves behind is neither an output nor part of a reading of the folder above.
            assert not exists(spark, target)
            assert inventory.list_inputs(spark, str(tmp_path / "deep")).count() == 0
            raise KeyboardInterrupt
    assert list((tmp_path / "deep").iterdir()) == []
    with committed(spark, target) as place:
        spark.range(5).write.parquet(place)
    assert spark.read.parquet(literal_path(target)).count() == 5
    with pytest.raises(FileExistsError):
        with committed(spark, target) as place:
            spark.range(6).write.parquet(place)
    assert spark.read.parquet(literal_path(target)).count() == 5
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["out[1]"]


def test_folders_with_brackets_are_read_back(spark, trips, tmp_path):
    out, staging, runs = (f"{tmp_path}/{n}[1]*" for n in ("out", "staging", "runs"))
    P.prepare(spark, trips.folder, trips.zones, out, staging=staging, buckets=4, runs=runs, run_id="a")
    again = P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/b", reuse_staging=staging, buckets=4)
    assert P.compare(spark, out, again.output, buckets=4)["left_rows"] == trips.output
    assert runlog.latest(runlog.read(spark, runs)).first().status == "complete"


def test_run_ids_are_names(spark, trips, tmp_path):
    with pytest.raises(ValueError, match="run id"):
        P.prepare(spark, trips.folder, trips.zones, f"{tmp_path}/out", run_id="../a")
