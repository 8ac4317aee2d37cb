"""Signed outputs, queues behind one pointer, index partitions and strict CSV."""

import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators import crawl
from millrace.sources import crawl_files, signed, sinks
from millrace.sources.versions import Versions, shared_folder


def evidence(spark):
    rows = [(0, "CC-2024-10", "Acme", "u2", 3, "2024-03-01", "2024-03-05"), (0, "CC-2024-10", "acme", "u1", 2, "2024-02-01", "2024-03-02"), (1, "CC-2024-18", "acme", "u0", 1, "2024-05-01", "2024-05-01"), (1, "CC-2024-18", "beta", "b", 4, "2024-05-02", "2024-05-03")]
    names = [c.split()[0] for c in crawl.EVIDENCE.split(", ")]
    rows = spark.createDataFrame(rows, "input_order int, crawl_id string, board_token string, example_observed_url string, observation_count bigint, f string, l string")
    return rows.withColumns({"first_observed_at": F.col("f").cast("timestamp"), "last_observed_at": F.col("l").cast("timestamp")}).select(*names)


def test_digest_does_not_depend_on_the_layout(spark):
    rows = evidence(spark)
    n, found = signed.digest(rows.repartition(1))
    assert n == 4 and {signed.digest(rows.repartition(k)) for k in (2, 3, 7)} == {(n, found)}
    assert signed.digest(rows.select(*reversed(rows.columns))) == (n, found)
    assert signed.digest(rows.union(rows.limit(1)))[1] != found
    assert signed.digest(rows.withColumn("board_token", F.lower("board_token")))[1] != found
    nulls, empty = (spark.createDataFrame([(v, 1)], "a string, b int") for v in (None, ""))
    assert signed.digest(nulls) != signed.digest(empty) and signed.digest(rows.limit(0))[0] == 0


def test_union_is_signed_and_a_changed_file_is_refused(spark):
    versions = Versions(spark, shared_folder(spark, "union"))
    assert signed.publish_union(versions, evidence(spark)) == 1
    tables = signed.read(versions)
    assert [(r.board_token, r.observation_count, r.crawl_ids, r.example_observed_url) for r in tables["union"].orderBy("board_token").collect()] == [("acme", 6, ["CC-2024-10", "CC-2024-18"], "u0"), ("beta", 4, ["CC-2024-18"], "b")]
    assert [(r["row"], r.input_order, r.board_token) for r in tables["evidence"].orderBy("row").collect()] == [(1, 0, "acme"), (2, 1, "acme"), (3, 1, "beta")]
    assert sorted(map(tuple, tables["inputs"].collect())) == [(0, 1, 1), (1, 2, 1)]
    other = Versions(spark, shared_folder(spark, "union"))
    signed.publish_union(other, evidence(spark).repartition(6))
    assert signed.signatures(other) == signed.signatures(versions)
    path = versions.manifest(1)["union"]
    tables["union"].where("board_token = 'beta'").write.mode("append").parquet(path)
    with pytest.raises(signed.Changed, match="union"):
        signed.read(versions)


def test_queue_is_published_as_a_whole(spark):
    path = shared_folder(spark, "queue")
    rows = spark.createDataFrame([(1, ["a", "b"], "x")], "id int, tags array<string>, t string")
    assert sinks.write_queue(rows, path) == 1
    before = sinks.queue_paths(spark, path)
    assert [r.tags for r in spark.read.json(before["json"]).collect()] == [["a", "b"]]
    assert [tuple(r) for r in spark.read.option("header", True).csv(before["csv"]).collect()] == [("1", "a; b", "x")]
    with pytest.raises(Exception, match="stop"):
        sinks.write_queue(rows.withColumn("t", F.raise_error(F.lit("stop")).cast("string")), path)
    assert sinks.queue_paths(spark, path) == before
    assert sinks.write_queue(rows.union(rows), path) == 2
    assert spark.read.json(sinks.queue_paths(spark, path)["json"]).count() == 2 and spark.read.json(before["json"]).count() == 1


def test_partitions_are_added_once_and_pruned(spark):
    folder, name = shared_folder(spark, "index"), f"idx_{uuid.uuid4().hex[:8]}"
    for c, s in (("CC-1", "warc"), ("CC-1", "robots"), ("CC-2", "warc")):
        spark.createDataFrame([(f"https://boards.example/{c}", "boards.example", 200, "2024-01-01")], "url string, url_host_name string, fetch_status int, fetch_time string").write.parquet(f"{folder}/crawl={c}/subset={s}")
    crawl_files.create_index(spark, name, "url STRING, url_host_name STRING, fetch_status INT, fetch_time STRING", folder)
    assert spark.table(name).count() == 0
    for _ in range(2):
        crawl_files.add_partition(spark, name, "CC-1", "warc")
    crawl_files.add_partition(spark, name, "CC-2", "warc")
    assert spark.table(name).count() == 2
    found = crawl.index_candidates(spark.table(name), "CC-1", "warc", ["boards.example"])
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(crawl" in plan and [r.board_token for r in found.collect()] == ["cc-1"]
    for bad in ("a;b", "a.b.c", "", "1x"):
        with pytest.raises(ValueError):
            crawl_files.create_index(spark, bad, "x INT", folder)
    with pytest.raises(ValueError):
        crawl_files.add_partition(spark, name, "x' OR '1", "warc")
    spark.sql(f"DROP TABLE {name}")


HEAD = "board_token,example_observed_url,observation_count,first_observed_at,last_observed_at\n"


@pytest.mark.parametrize(
    "text,fails",
    [
        (HEAD + 'Acme,"u,1",3,2024-01-01,2024-01-02\n', None),
        (HEAD, None),
        ("", "empty"),
        ("board_token," + HEAD, "repeated"),
        ("board_token,observation_count\na,1\n", "lacks"),
        ("crawl_id," + HEAD, "reserved"),
        ("," + HEAD, "blank"),
        (HEAD + "a,u,1,2024-01-01,2024-01-02,more\n", "."),
        (HEAD + "a,u,1\n", "."),
        (HEAD + "a,u,none,2024-01-01,2024-01-02\n", "bad candidate"),
        (HEAD + " ,u,1,2024-01-01,2024-01-02\n", "bad candidate"),
    ],
)
def test_strict_csv(spark, tmp_path, text, fails):
    path = tmp_path / "CC-1.csv"
    path.write_text(text)
    if fails:
        with pytest.raises(Exception, match=fails):
            crawl_files.candidates(spark, str(path), "CC-1", 0).collect()
    else:
        rows = [(r.board_token, r.example_observed_url, r.observation_count) for r in crawl_files.candidates(spark, str(path), "CC-1", 0).collect()]
        assert rows == ([("Acme", "u,1", 3)] if "Acme" in text else [])
