"""Command-line jobs: arguments and exit codes (in-process, reusing the test session)."""

import pytest

from tessera import cli
from tessera.sources.fixtures import write_fx_raw


@pytest.fixture(scope="module")
def landed(spark, events, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("cli") / "raw")
    write_fx_raw(events, root)
    return root


def test_raw_silver_table_quality_gold(spark, landed, tmp_path, capsys):
    silver = str(tmp_path / "silver")
    day = "2024-01-03"
    assert cli.main(["raw-to-silver", "--raw-root", landed, "--silver-root", silver, "--date", day,
                     "--glob", "*.txt"]) == 0
    assert "files" in capsys.readouterr().out
    assert cli.main(["raw-to-silver", "--raw-root", landed, "--silver-root", silver, "--date", "2031-01-01",
                     "--glob", "*.txt"]) == 3
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS cli_lh LOCATION '{tmp_path / 'wh'}'")
    assert cli.main(["silver-to-table", "--silver-root", silver, "--table", "cli_lh.silver_events", "--date", day]) == 0
    code = cli.main(["quality", "--table", "cli_lh.silver_events", "--date", day])
    assert code in (0, 2)
    assert cli.main(["gold", "--table", "cli_lh.silver_events", "--gold-namespace", "cli_gold", "--date", day]) == 0
    assert cli.main(["gold", "--table", "cli_lh.silver_events", "--gold-namespace", "cli_gold",
                     "--date", "2031-01-01"]) == 2
    assert cli.main(["gold-modes", "--table", "cli_lh.silver_events", "--date", day,
                     "--namespace-prefix", "cli_exp", "--metrics-table", "cli_lh.gold_runs"]) == 0
    assert sorted(r["mode"] for r in spark.table("cli_lh.gold_runs").collect()) == [
        "multi-pass", "single-pass", "with-cache"]
    assert cli.main(["schema-evolution", "--table", "cli_lh.silver_events", "--date", day]) == 0
    assert cli.main(["schema-evolution", "--table", "cli_lh.silver_events", "--date", "2031-01-01"]) == 3


def test_quality_exit_code_on_empty_day(spark, silver, tmp_path):
    from tessera.sources.tables import write_partitions

    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS cli_q LOCATION '{tmp_path / 'wh'}'")
    write_partitions(silver, "cli_q.silver_events")
    assert cli.main(["quality", "--table", "cli_q.silver_events", "--date", "2024-01-04",
                     "--results-table", "cli_q.quality_results", "--report-out", str(tmp_path / "report")]) == 0
    assert cli.main(["quality", "--table", "cli_q.silver_events", "--date", "2031-01-01",
                     "--results-table", "cli_q.quality_results"]) == 2
    results = spark.table("cli_q.quality_results")
    assert results.count() == 26  # 13 rules × 2 runs
    assert results.where("dt = '2031-01-01' AND rule = 'partition_not_empty'").first()["passed"] is False
    assert len(spark.read.text(str(tmp_path / "report")).collect()) == 1


def test_versions_exit_codes(spark, silver, tmp_path):
    import datetime as dt

    from tessera.sources import versioned

    root = str(tmp_path / "v")
    assert cli.main(["time-travel", "--root", root, "--date", "2024-01-05"]) == 2
    versioned.commit(silver, root, "append", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert cli.main(["time-travel", "--root", root, "--date", "2024-01-05"]) == 3
    versioned.commit(silver.limit(0), root, "overwrite", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc),
                     dates=["2024-01-05"])
    assert cli.main(["time-travel", "--root", root, "--date", "2024-01-05"]) == 0
    assert cli.main(["inspect", "--root", root, "--limit", "5"]) == 0


def test_bad_date_is_rejected():
    with pytest.raises(SystemExit):
        cli.main(["quality", "--date", "2024-13-01"])
