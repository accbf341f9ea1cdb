import hashlib

from sheafwork.llm import warc
from sheafwork.llm.common import written

LONG = "p" * 150


def test_round_trip(spark):
    rows = [(5, "http://a", LONG), (3, "http://b", LONG), (3, "http://b", LONG), (7, None, LONG), (None, "http://c", LONG), (1, "u\r\nv", "short"), (2, "x", "short"), (4, "x", None), (6, "x", ""), (8, "é", "ü" * 60), (9, "é", "ü" * 60), (10, "big", "y" * 400_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    bundles = written(warc.write_bundles(warc.plan_records(pages).repartition(2)), "b")
    got = sorted(map(tuple, warc.read_bundles(bundles).collect()), key=str)

    def want(i, html):
        raw = (html or "").encode()
        first = min(r[0] for r in rows if r[0] is not None and (r[2] or "") == (html or "")) if len(raw) >= 100 else i
        return i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if i == first else "revisit", None if i == first else first

    assert got == sorted((want(i, html) for i, _, html in rows), key=str)
    assert warc.read_bundles(warc.write_bundles(warc.plan_records(pages.limit(0)))).count() == 0


def test_records_by_identifier_and_as_files(spark, tmp_path):
    import zstandard
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(1 + i % 2, "http://a", f"text {i // 4} " * 40) for i in range(40)], "page_id long, url string, html string")
    bundles = written(warc.write_bundles(warc.plan_records(pages).repartition(4)), "b")
    index = bundles.select("bundle", F.explode("records").alias("r")).select("bundle", "r.*").collect()
    assert len(index) == len({r["record_id"] for r in index}) == 40 and len({r["bundle"] for r in index}) == 4
    for r in index[:3]:
        fields, payload = warc.read_record(bundles, r["record_id"])
        assert fields["WARC-Record-ID"] == f"<{r['record_id']}>" and fields["X-Page-ID"] == str(r["page_id"]) and int(fields["Content-Length"]) == len(payload)
    assert warc.read_record(bundles, index[0]["record_id"] + "9") is None and warc.read_record(bundles, "urn:bundle:none:0") is None
    for _ in range(2):
        warc.export_archives(bundles, tmp_path.as_uri())
    files = sorted(tmp_path.iterdir())
    assert [f.name for f in files] == sorted({r["bundle"] for r in index})
    raw = b"".join(zstandard.ZstdDecompressor().stream_reader(f.read_bytes(), read_across_frames=True).read() for f in files)
    assert raw.count(b"WARC/1.1\r\n") == 40


def test_frames_stand_alone():
    import zstandard

    writer = warc.BundleWriter()
    for i in range(50):
        writer.add(f"r{i}", bytes([i]) * 20_000)
    content, index = writer.take()
    reader = warc.BundleReader(content)
    assert len(reader.starts) > 5
    for i in (49, 0, 23):
        e = index[i]
        assert reader.record(e["frame"], e["offset"], e["length"]) == bytes([i]) * 20_000
    at, packed, size = reader.starts[2]
    assert len(zstandard.ZstdDecompressor().decompress(content[at : at + packed])) == size
    # any reader of the format takes the whole bundle, as it skips the seek table
    whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert len(whole) == 50 * 20_000
