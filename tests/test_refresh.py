from test_scale_rules import tables

from draftlake.plans import refresh
from draftlake.sources.tables import write_by_quarter


def test_refresh_reports_every_view(spark, tmp_path):
    _, _, t = tables(spark)
    out = str(tmp_path / "views")
    report = {r["view"]: r for r in refresh.refresh_all(spark, t, None, out, "v1").collect()}
    assert set(report) == set(refresh.VIEWS) and all(r["status"] == "ok" for r in report.values())
    counts = {r["view"]: r["row_count"] for r in refresh.refresh_report(t, None).collect()}
    assert counts == {v: r["row_count"] for v, r in report.items()}
    assert refresh.read_view(spark, out, "pair_counter", "v1").count() == counts["pair_counter"]


def test_failing_view_does_not_stop_the_rest(spark, tmp_path):
    _, _, t = tables(spark)
    broken = type(t)(t.contests, t.steps, t.players.drop("won"), t.items)
    report = {r["view"]: r["status"] for r in refresh.refresh_all(spark, broken, None, str(tmp_path / "x"), "v1").collect()}
    assert report["actor_item_profile"] == "failed" and report["pair_synergy"] == "ok"


def test_snapshots_and_quarters(spark, tmp_path):
    _, _, t = tables(spark)
    prof = refresh.VIEWS["actor_item_profile"](t, None)
    for _ in range(2):
        refresh.append_snapshot(prof, t.contests, "2001-01-01", str(tmp_path / "s"))
    refresh.append_snapshot(prof, t.contests, "2001-01-02", str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2 * prof.count()
    write_by_quarter(t.contests, str(tmp_path / "q"))
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "q")).select("quarter").distinct().collect()] == ["1970_q1"]
