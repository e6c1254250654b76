import gzip
import hashlib

from adlake.llm import op7_warc


def rows(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, record_id string, value long")


def read_back(spark, path):
    got = {}
    for r in op7_warc.read_archives(spark, path).orderBy("record_id", "chunk_no").collect():
        got.setdefault((r.record_id, r.page_id), []).append(r)
    return got


def test_round_trip_of_awkward_payloads(spark, tmp_path):
    sep = "\r\n\r\n"
    payloads = ["", "a", None, sep, sep * 3, "x" + sep, sep + "x", "x\r\n", "\r\nx", "x\r", "\r\r\n\r\n\n", "x\r\n\r", "\n\r\n\r\n\r",
                f"WARC/1.1\r\nWARC-Type: response{sep}WARC/1.1", "ü" * 999 + sep, "😀" * 20 + "\r\n" * 7]
    data = [(i, f"http://h/{i}\r\nX: y", p, "clash", 1) for i, p in enumerate(payloads)]
    for chunk in (1 << 18, 3):
        path = str(tmp_path / f"a{chunk}")
        op7_warc.write_archives(rows(spark, data).repartition(3), path, chunk_chars=chunk)
        got = {k[1]: v for k, v in read_back(spark, path).items()}
        assert sorted(got) == list(range(len(payloads)))
        for i, p in enumerate(payloads):
            want = (p or "").encode()
            assert b"".join(r.chunk for r in got[i]) == want
            assert got[i][-1].running_sha1 == hashlib.sha1(want).hexdigest() == got[i][0].declared_digest
            assert [r.chunk_no for r in got[i]] == list(range(1, len(got[i]) + 1))
            assert got[i][-1].last and not any(r.last for r in got[i][:-1])


def test_files_are_plain_warc(spark, tmp_path):
    path = tmp_path / "w"
    op7_warc.write_archives(rows(spark, [(5, "http://h/5", "body", None, None)]), str(path))
    text = b"".join(gzip.open(f).read() for f in sorted(path.glob("*.gz"))).decode()
    head, body = text.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and "Content-Length: 4" in head
    assert body == "body\r\n\r\n"


def test_revisits_ties_and_nulls(spark):
    big, small = "y" * 1000, "y" * 999
    data = [(1, "u", big, "r", 0), (2, "u", big, "r", 0), (2, "u", big, "r", 0), (None, "u", big, "r", 0), (None, None, None, None, None),
            (3, "u", small, "r", 0), (4, "u", small, "r", 0)]
    got = op7_warc.round_trip(rows(spark, data)).collect()
    assert len(got) == len(data)
    kinds = sorted(((r.page_id is None, r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted([(False, 1, 1000, "revisit", 2), (False, 2, 1000, "response", None), (False, 2, 1000, "response", None),
                            (True, 0, 1000, "revisit", 2), (True, 0, 0, "response", None), (False, 3, 999, "response", None),
                            (False, 4, 999, "response", None)], key=str)
    assert op7_warc.round_trip(rows(spark, [])).count() == 0
