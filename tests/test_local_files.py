"""Corpora of many files: those of a large local folder are listed and read by tasks."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from sluice.sources import local_files, readers


def rows_of(raw):
    text = F.to_json("body").alias("body")
    return sorted((tuple(r) for r in raw.select("prefix", "s3_key", text, "digest").collect()), key=str)


def test_the_driver_does_not_hold_the_files_of_a_large_corpus(spark, tmp_path):
    """Spark's reader keeps the name and size of every file on the driver, which 2 million files filled."""
    n = local_files.DRIVER_ENTRIES + 50
    expected = []
    for i in range(n):
        folder = tmp_path / "clean" / f"{i % 7}"
        if i < 7:
            folder.mkdir(parents=True)
        body = f'{{"text":"t{i}"}}'
        (folder / f"{i}.json").write_text(body)
        expected.append(("clean/", f"clean/{i % 7}/{i}.json", body, hashlib.sha256(body.encode()).hexdigest()))
    (tmp_path / "sensitive").mkdir()
    (tmp_path / "sensitive" / "x.json").write_text("{nope")
    raw = readers.read_corpus(spark, f"file://{tmp_path}/", ["clean/", "absent/", "sensitive/"], digests=True)
    assert len(raw.inputFiles()) < 100 and raw.rdd.getNumPartitions() < 100
    expected.append(("sensitive/", "sensitive/x.json", None, hashlib.sha256(b"{nope").hexdigest()))
    assert rows_of(raw) == sorted(expected, key=str)


@pytest.mark.parametrize("prefix", ["c l%25+/", "c l%25+", "c l%25+/deep/"])
def test_tasks_take_the_files_that_sparks_reader_takes(spark, tmp_path, monkeypatch, prefix):
    """Hidden, empty, odd and linked names, repeats of the root's name, folders beyond what a listing task goes on with."""
    top = tmp_path / "c l%25+"
    names = [
        "a.json", "b c.json", "d+%20é.json", "line\nend.json", "UP.JSON", "n.txt", ".h.json", "_h.json", "_k=v.json", "_metadata.json",
        ".hid/a.json", "_hid/a.json", "_k=v/a.json", "_metadata/a.json", "_common_metadata.d/a.json", "copy._COPYING_/a.json", "folder.json/a.json",
        f"deep/{str(top).lstrip('/')}/a.json", "deep/1/2/3/4/5/6/a.json", *(f"deep/many/{i}.json" for i in range(11)), *(f"deep/{i}/{i}.json" for i in range(9)),
    ]
    for i, name in enumerate(names):
        path = top / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"text": "t" * i}) if i % 5 else "{nope")
    (top / "empty.json").write_text("")
    (top / "bytes.json").write_bytes(b'{"text":"\xff"}')
    (top / "deep" / "link.json").symlink_to(top / "a.json")
    (top / "deep" / "folder_link").symlink_to(top / "deep" / "1")
    (top / "deep" / "nowhere.json").symlink_to(top / "gone.json")
    (top / "deep" / "itself.json").symlink_to(top / "deep" / "itself.json")
    (top / "deep" / "no_files").mkdir()
    by_spark = rows_of(readers.read_corpus(spark, str(tmp_path), [prefix], digests=True))
    assert len(by_spark) > 20
    for name, value in (("DRIVER_ENTRIES", 1), ("WALKED", 2), ("CHUNK_FILES", 3), ("CHUNK_BYTES", 70), ("TASK_FILES", 4)):
        monkeypatch.setattr(local_files, name, value)
    raw = readers.read_corpus(spark, str(tmp_path), [prefix], digests=True)
    assert all("sluice-listing" in path for path in raw.inputFiles())
    assert rows_of(raw) == by_spark
    with open(os.path.join(os.fsencode(top), b"deep", b"\xff.json"), "w") as file:  # Spark's reader leaves it out
        file.write("[1]")
    assert len(rows_of(readers.read_corpus(spark, str(tmp_path), [prefix], digests=True))) == len(by_spark) + 1


def test_only_local_folders_without_patterns_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(local_files, "DRIVER_ENTRIES", 1)
    for name in ("one/a.json", "two/a.json", "two/b.json", "b[12]/a.json", "b[12]/b.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("{}")
    assert local_files.large_folder(spark, f"{tmp_path}/two") == local_files.large_folder(spark, f"file:{tmp_path}/two") == f"{tmp_path}/two"
    for path in (f"{tmp_path}/one", f"{tmp_path}/none", f"{tmp_path}/two/a.json", f"{tmp_path}/b[12]", f"viewfs://s{tmp_path}/two", "two"):
        assert local_files.large_folder(spark, path) is None
    assert sorted(r.s3_key for r in readers.read_corpus(spark, str(tmp_path), ["one/", "two/a.json", "two/"]).collect()) == ["one/a.json", "two/a.json", "two/a.json", "two/b.json"]


def test_corpus_files_by_tasks(spark, tmp_path, monkeypatch):
    """The query gives the rows of its documents whichever way they are read; repeated rows and null texts among them."""
    rows = [(i, None if i % 11 == 0 else " \n" if i % 13 == 0 else f" t{i}\n") for i in range(400)] + [(3, " t3\n"), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    run = driver.queries()["corpus_files"]
    expected = sorted((["clean/", "sensitive/"][i % 3], str(i), f"t{i}") for i, text in rows if i is not None and i % 3 < 2 and text and text.strip())
    monkeypatch.setattr(local_files, "DRIVER_ENTRIES", 20)
    by_tasks = run(spark, str(tmp_path))
    assert all("sluice-listing" in path for path in by_tasks.inputFiles())
    assert sorted(map(tuple, by_tasks.collect())) == expected
    monkeypatch.undo()
    assert sorted(map(tuple, run(spark, str(tmp_path)).collect())) == expected
