import base64
import gzip
import hashlib
import tracemalloc

import pyarrow as pa
import pytest

from ledgerline.llm import warc

SCHEMA = "page_id long, url string, html string, date string"


def rows():
    out = [(i, f"http://h{i % 3}.example/p q?{i}", ["<p>same</p>", "<p>é漢\r\n\r\nWARC/1.0\r\n</p>", None, "", f"<p>{i}</p>"][i % 5], "clash") for i in range(60)]
    return out + [(100, None, "x" * 300_000, None), (None, "http://n.example/", "<p>same</p>", None), (7, "http://h1.example/p q?7", None, None)]


def plain(data):
    best = {}
    for page, _, html, _ in data:
        key = (html or "").encode()
        best[key] = max(best.get(key, -1), -1 if page is None else page)
    out, done = [], set()
    for page, _, html, _ in data:
        key = (html or "").encode()
        first = best[key] == (-1 if page is None else page) and key not in done
        if first:
            done.add(key)
        out.append((str(page), len(key), base64.b32encode(hashlib.sha1(key).digest()).decode(), "response" if first else "revisit", None if first else best[key]))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    out = warc.page_records(frame, f"{tmp_path}/out")
    got = sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect()), key=str)
    assert got == plain(rows())
    payloads = {bytes(r.payload) for r in warc.read_warc(spark, f"{tmp_path}/out").collect() if r.record_type == "response"}
    assert payloads == {(x[2] or "").encode() for x in rows()}


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_volumes_of_both_versions(version, packed):
    volume = warc.ArcVolume("v.arc", version, "1996120101")
    volume.add_page(5, "http://a b/", b"one\n\ntwo")
    volume._add("dns:a", "1.2.3.4", "text/dns", b"no http\n")
    content = gzip.compress(volume.content()[:100]) + gzip.compress(volume.content()[100:]) if packed else volume.content()
    found = list(warc.parse_arc(content))
    assert [x["uri"] for x in found] == ["filedesc://v.arc", "http://a%20b/", "dns:a"]
    assert [warc.record_type(x["uri"], x["block"]) for x in found] == ["warcinfo", "response", "resource"]
    assert warc.split_block(found[1]["block"])[1] == b"one\n\ntwo" and warc.page_number(warc.split_block(found[1]["block"])[0]) == 5
    assert {x["version"] for x in found} == {version} and warc.timestamp(found[0]["date"]) == "1996-12-01T01:00:00Z"


def test_damaged_and_empty(spark, tmp_path):
    volume = warc.ArcVolume("v.arc", 1, "20000101000000")
    volume.add_page(1, "http://a/", b"kept")
    content = volume.content() + b"http://b/ 1.1.1.1 20000101000000 text/html 999\nshort\n"
    records, problems = warc.convert(spark.createDataFrame([("v.arc", content)], "name string, content binary"))
    assert problems.count() == 1
    warc.write_warc(records, f"{tmp_path}/a", compress=False)
    assert [r.page_id for r in warc.read_warc(spark, f"{tmp_path}/a").collect() if r.record_type == "response"] == [1]
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.page_records(empty, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_archives_are_cut_by_bytes(spark, tmp_path, compress):
    """Records larger than an archive's size stand alone; each record is a gzip member of its own."""
    sizes = [10, 20_000, 300, 90_000, 50, 20_000, 20_000]
    body = lambda k: b"".join(hashlib.sha256(b"%d %d" % (k, i)).digest() for i in range(sizes[k] // 32 + 1))
    volume = warc.ArcVolume("v.arc", 1, "20000101000000")
    for k in range(len(sizes)):
        volume.add_page(k, f"http://h/{k}", body(k))
    records, _ = warc.convert(spark.createDataFrame([("v.arc", volume.content())], "name string, content binary"))
    warc.write_warc(records.coalesce(1), f"{tmp_path}/out", file_bytes=30_000, compress=compress)
    files = [p.read_bytes() for p in (tmp_path / "out").glob("part-*")]
    assert len(files) >= 2 and all(len(x) < 30_000 + 100_000 for x in files)
    if compress:
        members = [m for x in files for m in warc._members(x) if m]
        assert all(m.startswith(b"WARC/1.0") and m.count(b"WARC-Record-ID:") == 1 for m in members) and len(members) == len(sizes) + 1
    found = {r.page_id: bytes(r.payload) for r in warc.read_warc(spark, f"{tmp_path}/out").collect() if r.record_type == "response"}
    assert found == {k: body(k) for k in range(len(sizes))}


def test_archives_from_files(spark, tmp_path):
    for k, version in enumerate((1, 2)):
        volume = warc.ArcVolume(f"v{k}.arc", version, "19990102030405")
        volume.add_page(k, f"http://h/{k}", b"equal")
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/v{k}.arc.gz").write_bytes(gzip.compress(volume.content()))
    records, problems = warc.convert(warc.read_arc(spark, f"{tmp_path}/in"))
    warc.write_warc(records, f"{tmp_path}/out")
    found = {r.page_id: r for r in warc.read_warc(spark, f"{tmp_path}/out").collect() if r.record_type != "warcinfo"}
    assert problems.count() == 0 and found[1].record_type == "response" and bytes(found[1].payload) == b"equal"
    assert found[0].record_type == "revisit" and found[0].refers_to_id == found[1].record_id and found[0].payload_bytes == 5
    assert found[0].date == "1999-01-02T03:04:05Z"


class Plan:
    """Stands for any DataFrame or reader, and keeps the function that its tasks would run."""

    def __getattr__(self, name):
        return lambda *args: self.__dict__.update(task=args[0]) or self if name == "mapInArrow" else self

    def __call__(self, *args):
        return self


def peak(task, *arrays):
    """MB that a task holds at most beside its input; its rows are dropped as they come."""
    batch = pa.RecordBatch.from_arrays(list(arrays), [f"c{k}" for k in range(len(arrays))])
    tracemalloc.start()
    rows = sum(out.num_rows for out in task(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return rows, most


def archive(pages, size):
    """A small archive of pages that unpack to many times its bytes."""
    head = b"HTTP/1.1 200 OK\r\n\r\n"
    bodies = [b"%06d" % k + b"x" * size for k in range(pages)]
    row = lambda k: {"record_id": f"r{k}", "kind": "response", "uri": "u", "ip": "i", "date": "d", "mime": "m", "head": head, "payload_digest": warc.digest(bodies[k]), "refers_to": None, "payload": bodies[k]}
    return b"".join(gzip.compress(warc.warc_record(row(k)) + b"\r\n\r\n", 1) for k in range(pages))


@pytest.mark.parametrize("payload", [False, True])
def test_an_archive_is_not_held_unpacked(payload):
    content = archive(60, 1_000_000)
    plan = Plan()
    plan.read = plan
    rows, most = peak(warc.read_warc(plan, "", payload).task, pa.array([content], pa.binary()))
    assert rows == 60 and most < 30


def test_volumes_are_parsed_one_at_a_time():
    volumes = []
    for k in range(30):
        volume = warc.ArcVolume(f"v{k}.arc", 1, "20000101000000")
        volume.add_page(k, "http://a/", b"x" * 1_000_000)
        volumes.append(volume.content())
    rows, most = peak(warc.arc_records(Plan(), False).task, pa.array([f"v{k}" for k in range(30)]), pa.array(volumes, pa.binary()))
    assert rows == 60 and most < 15
