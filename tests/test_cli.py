"""The command line, over the small made-up race."""

import sys

import race_fixture as race

from lapwise import __main__ as cli


def test_one_run_does_it_all(spark, tmp_path, monkeypatch, capsys):
    raw = [f"{dataset}={path}" for dataset, path in race.land(tmp_path).items()]
    out = tmp_path / "out"
    monkeypatch.setattr(sys, "argv", ["lapwise", str(out), *raw, "--by-session", "--rows", "5"])
    cli.main()
    shown = capsys.readouterr().out
    for title in cli.REPORTS:
        assert title in shown
    assert "|        96|          96|      96|" in shown
    assert spark.read.parquet(str(out / "export" / "lap_mart.parquet")).count() == 96
