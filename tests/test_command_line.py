"""The steps as commands, sharing nothing but a directory."""

from __future__ import annotations

import json

import pytest

from daybook.__main__ import parser, run
from daybook.plans import reports
from daybook.sources.warehouse import Warehouse
from test_pipeline import DOCS, document


def test_steps_as_commands(spark, tmp_path, capsys):
    home = str(tmp_path / "home")
    (tmp_path / "responses.txt").write_text("\n".join(DOCS))
    (tmp_path / "universe.txt").write_text("aa\nbb # second\ncc\n")
    (tmp_path / "reference.csv").write_text('ticker,company_name,sector\nAA,"Aye, Inc.",Energy\nBB,Bee,Energy\nCC,Cee,Energy\n')

    def command(*words):
        code = run(spark, parser().parse_args(["--home", home, *words]))
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    source = ["--responses", str(tmp_path / "responses.txt"), "--as-of", "2024-03-08"]
    code, record = command("ingest", *source, "--universe", str(tmp_path / "universe.txt"))
    assert (code, record["bars_received"]) == (0, 15)
    code, record = command("ingest", *source, "--tickers", "aa, zz", "--backfill")
    assert (code, record["mode"], record["tickers_failed"], record["dates_rewritten"]) == (1, "backfill", 1, 0)
    assert command("publish", "--dry-run")[1]["files_uploaded"] == 5
    assert command("publish")[1]["files_uploaded"] == 5
    assert command("load")[1]["rows_after"] == 15
    code, record = command("build", "--reference", str(tmp_path / "reference.csv"), "--as-of", "2024-03-08")
    assert (code, record) == (0, {"pass": 29, "warn": 0, "error": 0, "skip": 0})
    assert command("freshness")[0] == 0
    assert command("roll") == (0, {"months_read": 0, "months_written": 1})
    assert command("roll") == (0, {"months_read": 0, "months_written": 0}), "no load since"

    house = Warehouse(spark, root=f"{home}/tables")
    rows = reports.marts_query(house.table("fct_daily_prices"), house.table("dim_tickers"))
    frame = reports.to_pandas(reports.ticker_history(rows, "BB"))
    assert list(frame.columns) == list(reports.REPORT_COLUMNS) and len(frame) == 5
    assert frame.iloc[-1].close == 15.25 and frame.company_name[0] == "Bee"
    text = reports.tiles_text(reports.latest_rows(rows)).filter("ticker = 'AA'").first()
    assert text.heading == "AA - Aye, Inc. - 08 Mar 2024" and text.high_52w_text == "—"
    try:
        reports.to_pandas(rows, max_rows=3)
        raise AssertionError("a long report must be refused")
    except ValueError:
        pass
    assert document("AA")
    with pytest.raises(SystemExit):
        parser().parse_args(["--home", home, "ingest", *source, "--days", "0"])
