"""Repeated pages that are written by different tasks."""

import pytest

from pulseloom.llm import warc


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_repeats_in_different_tasks(spark, threshold, tmp_path):
    """Record ids are unique and every revisit is told once, whatever the join strategy."""
    big, other = "<p>" + "é" * 600, "<q>" + "o" * 2000
    data = [(9, "u", big)] * 5 + [(9, None, big), (1, "a", big), (2, "b", big), (None, "c", big)]
    data += [(4, "d", other), (3, "e", other), (None, "f", "n" * 3000), (None, "f", "n" * 3000), (7, "s", "small")] * 2
    data += [(5, "once", "z" * 1500)]
    spark.createDataFrame(spark.sparkContext.parallelize(data, 8), "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages")
    conf = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.files.maxPartitionBytes": "1k",
            "spark.sql.files.openCostInBytes": "1k"}  # a task per file
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        pages = spark.read.parquet(f"{tmp_path}/pages")
        got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.report(pages).collect()]
        manifest = warc.write(pages, warc.common.run_dir(spark, "warc"))
        records = warc.read(manifest).select("record_type", "record_id").collect()
        captures = warc.assemble(warc.read(manifest)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    newest = {big: 9, other: 4}
    expected = [(i, len(t.encode()), "revisit", newest[t]) if t in newest and i != newest[t]
                else (i, len(t.encode()), "response", None) for i, _, t in data]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert len({r.record_id for r in records}) == len(records) == 3 * len(data)
    assert all(c.request_records == c.metadata_records == 1 for c in captures) and len(captures) == len(data)
