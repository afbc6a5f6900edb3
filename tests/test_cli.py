"""The command line runs the same jobs as the registered queries."""

from vitrine import cli
from vitrine.plans import queries as Q
from vitrine.session import scratch_path


def test_cli_etl_and_stream(spark):
    raw = Q.noisy_log(spark, "/root/testdata/sf0.001")
    counts = cli.main(["etl", "--input", raw, "--silver", scratch_path(spark, "cli-silver"),
                       "--warehouse-dir", scratch_path(spark, "cli-dw"), "--database", "cli_dw",
                       "--dt", "2024-01-31"], spark=spark)
    got = [r["table"] for r in counts.collect()]
    assert got.count("dw_sales_funnel_daily") == 6
    assert counts.where("table = 'rejects'").first()["rows"] > 0

    root = scratch_path(spark, "cli-stream")
    job = cli.main(["stream", "--source", raw, "--root", root, "--once",
                    "--tolerance-ms", str(Q.TOLERANCE_MS), "--window-ms", str(Q.WINDOW_MS),
                    "--slide-ms", str(Q.SLIDE_MS)], spark=spark)
    stream = sorted(tuple(r) for r in job.windows().select(*Q.WINDOW_OUT).collect())
    batch = sorted(tuple(r) for r in Q.QUERIES["sliding_clicks"](spark, "/root/testdata/sf0.001").collect())
    assert stream == batch


def test_settings_on_a_cluster():
    """The cluster's own settings stay; the others are sized by its cores; no local scratch folder."""
    import pytest

    from vitrine.session import default_settings, refuse_local_scratch
    got = default_settings(4000, {"spark.sql.files.maxPartitionBytes": "1g"})
    assert got["spark.sql.shuffle.partitions"] == "12000" and "spark.sql.files.maxPartitionBytes" not in got
    assert not any("master" in k or k.startswith("spark.ui") for k in got)
    for master in ("local", "local[*]", "local[8]"):
        refuse_local_scratch(master)
    for master in ("yarn", "spark://h:7077", "k8s://x", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            refuse_local_scratch(master)
