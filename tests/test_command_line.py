import json

import pytest

from factprep import __main__ as cli
from factprep.operators import runlog


def test_jobs(spark, trips, tmp_path, capsys):
    runs = f"{tmp_path}/runs"
    for run_id, extra in (("a", []), ("b", ["--staging", f"{tmp_path}/staging"])):
        done = cli.main(
            ["prepare", "--input", trips.folder, "--lookup", trips.zones, "--output", f"{tmp_path}/{run_id}"]
            + ["--buckets", "4", "--runs", runs, "--run-id", run_id, *extra]
        )
        assert done["output_rows"] == trips.output
    sides = ["compare", "--left", f"{tmp_path}/a", "--right", f"{tmp_path}/b"]
    assert cli.main([*sides, "--runs", runs, "--run-ids", "a", "b"])["exact_match"]
    with pytest.raises(ValueError, match="recorded"):
        cli.main([*sides, "--runs", runs, "--run-ids", "a", "unknown"])

    samples = tmp_path / "samples.csv"
    spans = runlog.latest(runlog.read(spark, runs)).collect()
    header = "utc,epoch_seconds,framework,run_id,node,cpu_percent,cpu_count,memory_used_bytes"
    header += ",memory_available_bytes,memory_total_bytes,swap_used_bytes"
    lines = [f",{r.timed_end_epoch},factprep,{r.run_id},n1,25.0,8,{2 << 30},0,0,0" for r in spans]
    samples.write_text("\n".join([header, *lines]) + "\n")
    cli.main(
        ["summarize", "--runs", runs, "--run-ids", "a", "b", "--output", f"{tmp_path}/report"]
        + ["--resources", str(samples), "--worker-nodes", "n1"]
    )
    table = spark.read.option("header", True).csv(f"{tmp_path}/report/benchmark_runs").collect()
    assert {(r.run_id, r.peak_cpu_percent, r.peak_memory_gib) for r in table} == {("a", "25.0", "2.0"), ("b", "25.0", "2.0")}
    assert spark.read.json(f"{tmp_path}/report/summary").first().trials == 2

    with pytest.raises(ValueError, match="twice"):
        cli.main([*sides, "--runs", runs, "--run-ids", "a", "a"])
    for run_id, extra in (("c", ["--oversized", "raise"]), ("d", ["--reuse-staging", f"{tmp_path}/streamed"])):
        cli.main(
            ["stage", "--input", trips.second, "--staging", f"{tmp_path}/streamed", "--checkpoint", f"{tmp_path}/progress"]
            + ["--buckets", "4"]
        )
        done = cli.main(
            ["prepare", "--input", trips.second, "--lookup", trips.zones, "--output", f"{tmp_path}/{run_id}"]
            + ["--buckets", "4", "--runs", runs, "--run-id", run_id, *extra]
        )
        assert done["output_rows"] == 4
    sides = ["compare", "--left", f"{tmp_path}/c", "--right", f"{tmp_path}/d"]
    assert cli.main([*sides, "--runs", runs, "--run-ids", "c", "d"])["bucket_count"] == 4
    totals = cli.main(["inventory", "--input", trips.folder, "--output", f"{tmp_path}/inventory"])
    assert (totals["files"], totals["row_count"]) == (2, trips.raw)
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == totals
