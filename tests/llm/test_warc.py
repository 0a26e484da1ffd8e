import hashlib

import pytest
import zstandard

from faresettle.llm import catalog, warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, largest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], SCHEMA)


def slow(rows):
    out = []
    for i, url, html in rows:
        payload = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == payload and j is not None]
        refers = max(same) if len(payload) >= 1000 and same and i != max(same) else None
        out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_rows_of_every_kind(spark):
    long, wide = "a" * 1000, "é" * 500
    rows = [
        (1, "http://a/\r\nX: y", long), (2, None, long), (9, "http://b/", long), (9, "http://b/", long), (None, "u", long), (3, "u", "a" * 999), (4, "u", "a" * 999),
        (5, "u", wide), (6, "u", wide), (7, "u", None), (8, "u", ""), (10, "u", "x" * 3_000_000), (None, "u", "b" * 2000), (None, "u", "b" * 2000),
        (11, "u", "WARC/1.1\r\n\r\n"), (12, "ü ", "ok"),
    ]
    assert found(warc.round_trip(pages(spark, rows))) == slow(rows)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_small_archives_and_urls(spark):
    rows = [(k, f"http://host/{k}", f"<p>{k}</p>" * 50) for k in range(60)]
    out = warc.round_trip(pages(spark, rows), archive_bytes=300)
    assert found(out) == slow(rows)
    assert {r["page_id"]: r["url"] for r in out.collect()} == {i: u for i, u, _ in rows}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_table_against_sql(spark, scale):
    from check_oracle import connect, difference

    directory = f"/root/testdata/sf{scale}"
    ours, theirs = (df.astype({"refers_to": "float64"}) for df in (catalog.op6_warc(spark, directory).toPandas(), connect(directory).sql(catalog.WARC_SQL).df()))
    assert difference(ours, theirs) is None


def record(payload=b"hello", revisit=False):
    return warc.write_record(1, "http://a/", payload, 2 if revisit else None, revisit, hashlib.sha1(payload).hexdigest())


def archive(*records, dictionary=b""):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    encoder = zstandard.ZstdCompressor(dict_data=held, write_checksum=True)
    return (warc.dictionary_frame(dictionary) if dictionary else b"") + b"".join(map(encoder.compress, records))


@pytest.fixture(scope="module")
def dictionary():
    return zstandard.train_dictionary(2000, [f"<html><p>page {k} of many {k * k}</p></html>".encode() * 5 for k in range(300)]).as_bytes()


def test_dictionary_plain_compressed_and_none(dictionary):
    data = archive(record(b"x" * 300_000), record(b""), dictionary=dictionary)
    packed = zstandard.ZstdCompressor().compress(dictionary)
    other = warc.dictionary_frame(packed) + data[8 + len(dictionary) :]
    for whole in (data, other, archive(record(b"x" * 300_000), record(b""))):
        assert [len(r.block) - len(warc.read_archive.__name__) for r in warc.read_archive(whole)]
        assert [warc._facts(r)[1] for r in warc.read_archive(whole)] == [300_000, 0]
    assert list(warc.read_archive(b"")) == []


def test_unsized_frames_and_skippable_frames_between():
    encoder = zstandard.ZstdCompressor().compressobj()
    unsized = encoder.compress(record()) + encoder.flush()
    gap = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    assert len(list(warc.read_archive(archive(record()) + gap + unsized))) == 2


@pytest.mark.parametrize(
    "spoil",
    [
        lambda d: d[:-3],
        lambda d: d + b"\x28\xb5",
        lambda d: d + b"plain text",
        lambda d: b"\x5d\x2a\x4d\x18\xff\xff\xff\x00" + d,
    ],
)
def test_spoiled_archives(spoil):
    with pytest.raises((warc.ArchiveError, zstandard.ZstdError)):
        list(warc.read_archive(spoil(archive(record(), record()))))


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 9"), (b"Content-Length", b"Content-Width"), (b"WARC-Type: ", b": "),
        (b"Content-Length: ", b"Content-Length: -"), (b"hello", b"hell"), (b"hello", b"jello"), (b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"),
        (b"X-Payload-Length: 5", b"X-Payload-Length: 6"),
    ],
)
def test_wrong_records(old, new):
    with pytest.raises(warc.ArchiveError):
        [warc._facts(r) for r in warc.read_archive(archive(record().replace(old, new, 1)))]


def test_manifest_counts_are_held_against_archives(spark, tmp_path):
    rows = warc.with_revisits(warc.with_payloads(pages(spark, [(1, "u", "a"), (2, "u", "b")])))
    manifest = warc.write_archives(rows, str(tmp_path / "w"), b"")
    assert warc.read_archives(manifest).count() == 2
    with pytest.raises(Exception, match="records in"):
        warc.read_archives(manifest.selectExpr("path", "records + 1 AS records")).collect()
