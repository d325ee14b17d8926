from hashlib import sha256

import pytest

from tillwright.llm import warc
from tillwright.session import setting

SCHEMA = "page_id long, url string, html string, digest string, n int"
INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
LONG = "<p>" + "x" * 200 + "</p>"
PAGES = [
    (1, "http://a/", "<p>short</p>", "d", 1),
    (2, "http://b/", "<p>short</p>", "d", 1),
    (7, "http://c/WARC/1.1 \r\n\nWARC/1.1\r\n", LONG, None, None),
    (5, None, LONG, None, None),
    (5, None, LONG, None, None),
    (9, "", None, None, None),
    (10, "u", "", None, None),
    (None, "u", LONG, None, None),
    (11, "u", INNER * 3, None, None),
    (12, "u", "\n" + INNER + "y" * 300 + "\nWARC/1.1\r\nContent-Length: 100000\r\n\r\n", None, None),
    (13, "u", "éü日" * 100 + "\r\n\r\n\r\n", None, None),
    (14, "u", "WARC/1.0\r\n" * 200, None, None),
    (15, "u", "long " * 60000 + INNER * 50, None, None),
]


def plain(pages):
    first, found = {}, []
    bodies = [(p, (h or "").encode()) for p, _, h, *_ in pages]
    for p, b in bodies:
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    for p, b in bodies:
        again = b in first and first[b] != p
        found.append((p, len(b), sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("split", ["128m", "700", "4096"])
def test_round_trip(spark, tmp_path, split):
    warc.write(spark.createDataFrame(PAGES, SCHEMA).coalesce(2), str(tmp_path / "w"))
    with setting(spark, "spark.sql.files.maxPartitionBytes", split):
        got = sorted((tuple(r) for r in warc.resolved(warc.records(spark, str(tmp_path / "w"))).collect()), key=repr)
    assert got == plain(PAGES)


def test_page_ids_with_several_payloads(spark, tmp_path):
    one, other = "A" * 150, "B" * 333
    pages = [(k, "u", body, None, None) for k, body in ((5, one), (5, other), (9, one), (8, other), (5, "C" * 120), (7, one + other), (8, one + other))]
    warc.write(spark.createDataFrame(pages, SCHEMA), str(tmp_path / "w"))
    got = sorted((tuple(r) for r in warc.resolved(warc.records(spark, str(tmp_path / "w"))).collect()), key=repr)
    assert got == plain(pages)


def test_archive_is_plain_warc(spark, tmp_path):
    warc.write(spark.createDataFrame(PAGES[:4], SCHEMA).coalesce(1), str(tmp_path / "w"))
    data = b"".join(f.read_bytes() for f in (tmp_path / "w").glob("part-*"))
    at = n = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        fields = dict(line.split(b": ", 1) for line in data[at:head].split(b"\r\n")[1:] if line)
        at = head + int(fields[b"Content-Length"]) + 4
        assert data[at - 4 : at] == b"\r\n\r\n"
        n += 1
    assert n == 4


def test_damage_and_nothing(spark, tmp_path):
    def block(page, body):
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()

    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "good").write_bytes(block(1, "one") + block(2, "WARC/1.1\r\n") + block(3, ""))
    (tmp_path / "x" / "broken").write_bytes(block(4, "four") + b"junk\n" + block(5, "five"))
    (tmp_path / "x" / "other").write_bytes(b"no archive\n" + block(6, "six"))
    assert sorted(r.page_id for r in warc.records(spark, str(tmp_path / "x")).collect()) == [1, 2, 3, 4]
    warc.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert warc.resolved(warc.records(spark, str(tmp_path / "e"))).count() == 0
