"""Files of one text each."""

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from lodestock.sources import documents


def test_tasks_write_a_file_for_every_text(spark, tmp_path, monkeypatch):
    texts = ["a", "", None, "ß\n\nb", "a"] + [str(i) for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    df.write.text(f"{tmp_path}/plain")
    monkeypatch.setattr(DataFrameWriter, "text", lambda *a, **k: pytest.fail("a process for the rights of every file"))
    monkeypatch.setattr(documents, "FOLDER_FILES", 3)
    documents.write_documents(df, "text", f"{tmp_path}/a b/texts")
    files = list((tmp_path / "a b" / "texts").glob("folder=*/*"))
    assert len(files) == len(texts) and all(f.suffix == ".txt" for f in files)
    assert max(len(list(f.glob("*"))) for f in (tmp_path / "a b" / "texts").glob("*")) == 3
    assert sorted(f.read_bytes().decode() for f in files) == sorted((t or "") + "\n" for t in texts)
    read = documents.read_documents(spark, f"{tmp_path}/a b/texts")
    assert read.columns == ["doc", "text", "folder"]
    assert sorted(r["text"] for r in read.collect()) == sorted((t or "") + "\n" for t in texts)
    whole = "".join(f.read_text() for f in sorted((tmp_path / "plain").glob("*.txt")))
    assert sorted(whole) == sorted("".join(f.read_text() for f in files))


def test_no_texts_are_no_files(spark, tmp_path):
    documents.write_documents(spark.createDataFrame([], "text string"), "text", f"{tmp_path}/texts")
    assert list((tmp_path / "texts").glob("*")) == []


def test_tasks_read_what_spark_reads(spark, tmp_path, monkeypatch):
    for i, name in enumerate(["a.txt", "b c%20#é.txt", "d.txt.bak", ".hidden.txt", "_own.txt", "e.txt", "f.txt"]):
        folder = tmp_path / "x y" / f"lang={'de' if i % 2 else 'en'}" / f"n={i % 3:02}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"" if name == "e.txt" else f"{name}\r\n\n".encode() + b"\xff")
    for at in ("lang=en/n=00", "lang=de/n=words"):
        (tmp_path / "x y" / at).mkdir(exist_ok=True)
        (tmp_path / "x y" / at / "0.txt").write_bytes(b"")
    (tmp_path / "flat").mkdir()
    for i in range(50):
        (tmp_path / "flat" / f"{i}.txt").write_text(str(i))
    (tmp_path / "deep" / "more").mkdir(parents=True)
    (tmp_path / "deep" / "f.txt").write_text("top")
    (tmp_path / "deep" / "more" / "g.txt").write_text("below")
    seen = lambda df: (df.schema, sorted(map(str, df.withColumn("text", F.hex("text")).collect())))
    monkeypatch.setattr(documents, "BATCH_BYTES", 1)
    ours = [seen(documents.read_documents(spark, f"{tmp_path}/{p}")) for p in ("x y", "flat", "deep")]
    assert documents._read_by_tasks(spark, f"{tmp_path}/deep", f"{tmp_path}/deep", ".txt") is None
    assert documents._read_by_tasks(spark, f"{tmp_path}/flat", f"{tmp_path}/flat", ".txt").rdd.getNumPartitions() > 1
    monkeypatch.setattr(documents, "_mounted", lambda *a: None)
    assert ours == [seen(documents.read_documents(spark, f"{tmp_path}/{p}")) for p in ("x y", "flat", "deep")]
    assert len(ours[0][1]) == 3 and [f.dataType.simpleString() for f in ours[0][0]] == ["string"] * 4 and len(ours[1][1]) == 50
