"""Feed archives: records, partitions, batches and streams."""

import io
import os

import pytest

from gladwire.sources import archive


def write(folder, name, *records, tail=b"", when=None):
    body = b"".join(k.encode() + b"\t" + str(len(d)).encode() + b"\n" + d + b"\n" for k, d in records) + tail
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body)
    if when is not None:
        os.utime(path, ns=(when, when))


def rows(frame):
    return sorted((r.source_id, r.xml) for r in frame.collect())


@pytest.fixture
def read(spark, tmp_path):
    archive.register(spark)
    return lambda **options: spark.read.format(archive.FORMAT).options(**options).load(str(tmp_path / "in"))


def test_records_of_any_bytes(tmp_path, read):
    folder = tmp_path / "in"
    long = ("<rss>" + "é\n" * 100_000 + "</rss>").encode()
    write(folder, "a", ("one", b"<rss>\n\n</rss>"), ("key\twith tab", b""), ("two", long), tail=b"cut\t50\n<rss>")
    write(folder, "sub/b", ("three", b"\xff<x/>"))
    write(folder, "empty")
    write(folder, "_SUCCESS", tail=b"no header")
    write(folder, "_temporary/0/part", ("never", b"x"))
    write(folder, ".hidden", ("never", b"x"))
    found = read()
    assert rows(found) == [("key\twith tab", ""), ("one", "<rss>\n\n</rss>"), ("three", "�<x/>"), ("two", long.decode())]
    assert {os.path.basename(r.file) for r in found.select("file").distinct().collect()} == {"a", "b"}


def test_small_files_share_a_partition(tmp_path, read):
    for i in range(20):
        write(tmp_path / "in", f"f{i:02}", (f"s{i}", b"x" * 100))
    assert read().rdd.getNumPartitions() == 1 and read(partition_bytes="300").rdd.getNumPartitions() == 10
    assert len(rows(read(partition_bytes="300"))) == 20


def test_malformed_headers(tmp_path, read):
    write(tmp_path / "in", "a", ("one", b"x"), tail=b"no header\n")
    with pytest.raises(Exception, match="not a header"):
        read().collect()
    assert rows(read(mode="DROPMALFORMED")) == [("one", "x")]


def test_readers_of_lines_in_small_steps():
    lines = archive._Lines(io.BytesIO(b"k\t3\nab\n\nlast\t2\nxy"), step=2)
    assert list(archive.documents(lines)) == [("k", b"ab\n"), ("last", b"xy")]


def test_written_archives_come_back(spark, tmp_path, read):
    feeds = spark.createDataFrame([("a", "<x>\né</x>"), ("b", None), (None, "")], "source_id string, xml string")
    archive.write_archive(feeds.repartition(3), str(tmp_path / "in"))
    assert rows(read()) == [("", ""), ("a", "<x>\né</x>")]


def test_offsets_take_every_file_once(tmp_path):
    folder = tmp_path / "in"
    second = 10**9
    reader = archive._StreamReader({"path": str(folder), "lateness": "100"})
    folder.mkdir()
    start = reader.initialOffset()
    assert reader.latestOffset() == start and reader.partitions(start, start) == []
    taken = []

    def step():
        nonlocal start
        end = reader.latestOffset()
        taken.append(sorted(os.path.basename(p) for part in reader.partitions(start, end) for p in part.paths))
        again = archive._StreamReader({"path": str(folder), "lateness": "100"}).partitions(start, end)
        assert sorted(os.path.basename(p) for part in again for p in part.paths) == taken[-1]
        start = end

    write(folder, "b", when=1000 * second)
    step()
    write(folder, "a", when=950 * second)  # moved in later, changed earlier
    write(folder, "c", when=1000 * second)
    step()
    write(folder, "d", when=1500 * second)
    step()
    step()
    assert taken == [["b"], ["a", "c"], ["d"], []]


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a", ("one", b"1"))
    stream = archive.register(spark).readStream.format(archive.FORMAT).load(str(folder))

    def run():
        query = (stream.select("source_id", "xml").writeStream.format("parquet").option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "cp")).start())
        try:
            query.processAllAvailable()
            write(folder, f"f{len(os.listdir(folder))}", ("two", b"2"))
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("one", "1"), ("two", "2")]
    run()  # goes on from its checkpoint
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("one", "1"), ("two", "2"), ("two", "2")]
