import base64
import gzip
import hashlib
import os
import uuid

from pyspark.sql import functions as F

from tideline.llm import warc
from tideline.session import materialize, work_dir

PAGES = "page_id long, url string, html string"


def archive(spark, rows, min_bytes=0, block_lines=7, file_bytes=4000, schema=PAGES):
    pages = spark.createDataFrame(rows, schema).repartition(3)
    folder = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    captures = materialize(warc.write(warc.decide(pages, min_bytes), folder, file_bytes), "captures")
    directory = materialize(warc.index(captures, folder, block_lines), "directory")
    return folder, captures, directory


def rows_of(n=60):
    rows = [(i, f"https://h{i % 7}.example.{['net', 'org'][i % 2]}/p/{i}?q", f"<p>{'text ' * (i % 5)}</p>") for i in range(n)]
    rows += [(100, None, None), (101, "no scheme", ""), (102, "http://x\ny\tz/%0A", "é ü 你"), (103, "http://big.net/", "<b>" * 50_000)]
    return rows


def want(rows, min_bytes=0):
    first, out = {}, {}
    for page_id, url, html in sorted(rows):
        data = (html or "").encode()
        refers = first.setdefault(data, page_id) if len(data) >= min_bytes else page_id
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[page_id] = (url, len(data), digest, "response" if refers == page_id else "revisit", None if refers == page_id else refers, data)
    return out


def test_round_trip_through_the_index(spark):
    rows = rows_of()
    for min_bytes in (0, 20):
        folder, _, directory = archive(spark, rows, min_bytes)
        expected = want(rows, min_bytes)
        got = warc.read(directory, folder).collect()
        assert len(got) == len(rows)
        for r in got:
            url, size, digest, kind, refers, data = expected[r["page_id"]]
            assert (r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (url, size, digest, kind, refers)
            assert r["payload"] == (data if kind == "response" else None)


def test_files_are_warc_members(spark):
    folder, captures, _ = archive(spark, rows_of())
    for name in {r["file"] for r in captures.select("file").collect()}:
        with open(os.path.join(folder, name), "rb") as f:
            whole = f.read()
        places = sorted((r["offset"], r["length"]) for r in captures.where(F.col("file") == name).collect())
        assert [o for o, _ in places] == [0, *[o + n for o, n in places][:-1]] and sum(n for _, n in places) == len(whole)
        plain = b"".join(gzip.decompress(whole[o : o + n]) for o, n in places)
        assert plain == gzip.decompress(whole) and plain.startswith(b"WARC/1.1\r\n") and plain.endswith(b"\r\n\r\n")


def test_blocks_are_sorted_and_look_up_finds_all_captures(spark):
    rows = rows_of() + [(200 + i, "http://same.net/x", f"v{i}") for i in range(30)]
    folder, captures, directory = archive(spark, rows)
    blocks = sorted((r["first_key"], r["last_key"], r["lines"]) for r in directory.collect())
    assert sum(n for _, _, n in blocks) == len(rows) and all(a <= b for a, b, _ in blocks)
    assert all(before[1] <= after[0] for before, after in zip(blocks, blocks[1:]))
    keys = {r["page_id"]: r["key"] for r in captures.collect()}
    assert keys[200] == "net,same)/x" and keys[100] == ")"
    asked = [keys[200], keys[102], keys[7], keys[101], "unknown", "zzz"]
    got = sorted((r["key"], r["page_id"]) for r in warc.look_up(directory, folder, asked).collect())
    assert got == sorted((k, i) for i, k in keys.items() if k in asked)
    assert warc.look_up(directory, folder, []).collect() == []


def test_a_table_of_keys_is_looked_up_in_many_runs(spark, monkeypatch):
    rows = rows_of() + [(1000 + i, "http://same.net/x", f"v{i}") for i in range(120)]
    folder, captures, directory = archive(spark, rows, block_lines=4)
    asked = captures.select("key").unionByName(spark.createDataFrame([("zzz",), (None,), ("",)], "key string"))
    expected = want(rows)
    for groups in (1, 5, 1024):
        monkeypatch.setattr(warc, "GROUPS", groups)
        got = warc.look_up(directory, folder, asked).collect()
        assert sorted(r["page_id"] for r in got) == sorted(expected)
        for r in got:
            url, size, digest, kind, refers, data = expected[r["page_id"]]
            assert (r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (url, size, digest, kind, refers)
    # Only blocks that can hold a key are read: the others need not even be there.
    one = captures.where("page_id = 7").select("key")
    key = one.first()["key"]
    broken = directory.withColumn("file", F.when((F.col("first_key") <= key) & (F.col("last_key") >= key), F.col("file")).otherwise("gone"))
    assert [r["page_id"] for r in warc.look_up(materialize(broken, "broken"), folder, one).collect()] == [7]


def test_missing_and_repeated_ids_extra_columns_and_empty_table(spark):
    rows = [(None, "http://a/", "x", 1), (None, "http://a/", "x", 1), (3, "http://b/", "x", 1), (3, "http://b/", "x", 1), (2, "http://c/", "x", 1)]
    folder, _, directory = archive(spark, rows, schema=PAGES + ", payload int")
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in warc.read(directory, folder).collect())
    assert got == [("2", "response", None), ("3", "revisit", 2), ("3", "revisit", 2), ("None", "response", None), ("None", "response", None)]
    folder, captures, directory = archive(spark, [])
    assert captures.collect() == [] and warc.read(directory, folder).collect() == []
    assert warc.look_up(directory, folder, ["x"]).collect() == []
