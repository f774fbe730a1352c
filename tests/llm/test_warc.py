import base64
import gzip
import hashlib

import pytest
from loamline.llm import warc as w


def brute(rows, least=0):
    data = [((h or "").encode(), p) for p, _, h in rows]
    first = {}
    for b, p in data:
        if p is not None:
            first[b] = min(p, first.get(b, p))
    out = []
    for b, p in data:
        again = len(b) >= least and b in first and first[b] != p
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip_against_brute_force(spark, version):
    rows = [(i, f"http://h/{i} x\n", f"<p>{i % 7} é\r\n\r\nWARC/1.1\r\n</p>\n" * (i % 5)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", "<p>only</p>"), (None, "u", ""), (102, "u", "x" * 300_000), (102, "u", "x" * 300_000), (7, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string")
    for least in (0, 30):
        got = w.through_archives(pages, least, archive_bytes=2000, version=version).collect()
        assert sorted((tuple(g)[:5] for g in got), key=str) == brute(rows, least)
    assert len({g["record_id"] for g in got}) >= len(got) - 1


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert w.through_archives(pages).count() == 0


def test_formats():
    data = w.arc_file([("http://a/", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody\n\n")], 2)
    (h0, _), (h, c) = w.arc_records(data)
    assert h0["URL"].startswith("filedesc:") and h["Result-code"] == "200" and c.endswith(b"body\n\n")
    assert w.warc_date("19990102030405") == "1999-01-02T03:04:05Z"
    for bad in (b"http://a/ 0.0.0.0 1 t 3\nabc\n", data[:-9], data.replace(b"2 0", b"1 0", 1)):
        with pytest.raises(ValueError):
            list(w.arc_records(bad))


def test_foreign_archives(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + bytes(range(256)) * 9
    latin = b"HTTP/1.0 200 OK\r\nServer: caf\xe9\r\nno colon here\r\nX-Folded:tight\r\n\r\n<p>d\xe9j\xe0 vu</p>"
    records = [("http://a/one two", "text/html", latin), ("http://a/\udce9", "text/html", b"HTTP/1.1 200 OK\nA: b\n\nbody"), ("http://a/x.png", "image/png", b"HTTP/1.1 200 OK\r\nContent-Length: 9999\r\n\r\n" + png)]
    records += [("dns:a", "text/dns", b"20240101 a. IN A 1.2.3.4\n\xff"), ("http://a/cut", "text/html", b"HTTP/1.1 204 No Content"), ("http://a/again", "text/html", latin)]
    head = "1 0 loamline\n" + " ".join(w.FIELDS[1]) + "\n\n"
    lines = [f"filedesc://a.arc 0.0.0.0 {w.DATE} text/plain {len(head)}\n{head}\n".encode()]
    lines += [w.bytes_of(f"{u} 0.0.0.0 {w.DATE} {k} {len(c)}\n") + c + b"\n" for u, k, c in records]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc.gz").write_bytes(gzip.compress(b"".join(lines)))
    w.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    (file,) = (tmp_path / "warc").glob("*.gz")
    found = list(w.warc_records(gzip.decompress(file.read_bytes())))
    assert [b for _, b in found[1:]] == [c for _, _, c in records]
    assert [f["WARC-Type"] for f, _ in found] == ["warcinfo", "response", "response", "response", "resource", "response", "response"]
    assert [f["WARC-Target-URI"] for f, _ in found[1:]] == [u for u, _, _ in records]
    rows = w.read_warc(spark, str(tmp_path / "warc")).collect()
    digests = {r["url"]: r["payload_digest"] for r in rows}
    assert digests["http://a/x.png"] == w.sha1(png) and digests["dns:a"] == w.sha1(records[3][2]) and digests["http://a/cut"] == w.sha1(b"")
    assert all(r["page_id"] is None and r["refers_to"] is None for r in rows)


def test_batches_hold_as_much_as_an_archive(spark, tmp_path, monkeypatch):
    """Ten thousand pages at once, or four thousand in Spark's reader, would take memory by the length of pages."""
    seen, read, names = tmp_path / "seen", [], ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    pieces, write, before = w.pieces, w._write, [spark.conf.get(n) for n in names]

    def noted(batches, *a):
        def each():
            for b in batches:
                with open(seen, "a") as f:
                    f.write(f"{b.num_rows} {b.nbytes}\n")
                yield b

        return pieces(each(), *a)

    monkeypatch.setattr(w, "pieces", noted)
    monkeypatch.setattr(w, "_write", lambda *a: (read.append(spark.conf.get(names[1])), write(*a)))
    spark.range(0, 300, 1, 1).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(chr(97 + id % 26), 20000) as html").write.parquet(str(tmp_path / "pages"))
    w.write_arc(spark.read.parquet(str(tmp_path / "pages")), str(tmp_path / "arc"), archive_bytes=100_000)
    batches = [tuple(map(int, x.split())) for x in seen.read_text().splitlines()]
    assert sum(n for n, _ in batches) == 300 and max(size for _, size in batches) < 150_000
    assert [int(x) <= 256 for x in read] == [True] and [spark.conf.get(n) for n in names] == before


def test_archives_are_unpacked_once_for_the_index(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 9}</p>") for i in range(90)], "page_id long, url string, html string")
    w.write_arc(pages, str(tmp_path / "arc"), archive_bytes=200)
    seen, index = tmp_path / "seen", w.arc_index

    def noted(batches):
        for b in batches:
            with open(seen, "a") as f:
                f.write("x" * b.num_rows)
            yield b

    def counted(*a):
        found = index(*a)
        return found.mapInArrow(noted, found.schema)

    monkeypatch.setattr(w, "arc_index", counted)
    w.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    assert len(seen.read_text()) == 90
    types = [r["record_type"] for r in w.read_warc(spark, str(tmp_path / "warc")).collect()]
    assert sorted(types) == ["response"] * 9 + ["revisit"] * 81
