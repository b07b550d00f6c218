import gzip
import hashlib
import io
import random
from collections import defaultdict

import pytest

import __spark_entry__ as contract
from orderloom.llm import arc_warc as aw
from orderloom.llm.common import open_store

from .frames import clashing

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    groups = defaultdict(list)
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            groups[data].append(page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        top = max(groups.get(data, []), default=None)
        revisit = top is not None and (page is None or page < top)
        digest = hashlib.sha1(data).hexdigest()
        out.append((page, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def whole_trip(pages):
    found = aw.with_referred(aw.read_warc(aw.convert(aw.write_arc(pages))))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, found.select(*columns).collect()), key=repr)


def test_query_on_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()
    found = contract.queries()["op8_arc_to_warc"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == plain([tuple(r) for r in pages])


def test_copies_nulls_ties_and_long_pages(spark):
    pick = random.Random(4)
    big = "x" * 999 + "é"
    pool = [None, "", "a", "b" * 999, "c" * 1000, big, "é" * 500, "é" * 499, "<p>\r\n\r\nWARC/1.1\r\n</p>" * 80, "z" * 3_000_000]
    rows = [(i, pick.choice(["http://a b/c\nd", None, "", "http://é/"]), pick.choice(pool[:9])) for i in range(300)]
    rows += [(300, "u", pool[9]), (301, "u", pool[9]), (None, "u", pool[4]), (None, None, "only" * 300), (None, "v", "only" * 300), (299, "t", pool[4]), (302, "t", pool[4]), (302, "t", pool[4])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert whole_trip(clashing(df)) == plain([(r[0], r[2]) for r in rows])
    assert whole_trip(df.limit(0)) == []


def test_versions_dates_and_header_lines():
    for version in "12":
        for url in ("http://a/", "http://with space/x y"):
            record = aw.arc_record(7, url.replace(" ", "_"), "<b>", "n.arc", version, "199901020304")
            record = record.replace(b"_", b" ")
            data = aw.version_block("n.arc", version, "1999") + record + b"\n" + record
            got = list(aw.arc_records(io.BytesIO(data)))
            assert len(got) == 2 and got[0] == got[1]
            assert got[0][0]["url"] == url and got[0][0]["archive-date"] == "199901020304"
            assert aw.http_parts(got[0][1])[1] == b"<b>"
    # Metadata behind the field line belongs to the version block.
    block = b"1 1 Somebody\nURL IP-address Archive-date Content-type Archive-length\n<xml/>\n"
    data = b"filedesc://x 0.0.0.0 1999 text/plain %d\n" % len(block) + block + b"\ndns:a 1.1.1.1 19990102030405 text/dns 3\nabc\n"
    ((fields, body),) = aw.arc_records(io.BytesIO(data))
    assert fields["url"] == "dns:a" and body == b"abc"
    with pytest.raises(ValueError, match="cut short"):
        list(aw.arc_records(io.BytesIO(data[:-3])))
    assert aw.warc_date("19990102030405") == "1999-01-02T03:04:05Z"
    assert aw.warc_date("199901020304") == "1999-01-02T03:04:00Z"
    assert aw.warc_date("1999") == "1999-01-01T00:00:00Z"
    assert aw.warc_date("soon") == "1970-01-01T00:00:00Z"
    other = gzip.decompress(aw.warc_record("n", 0, fields, body, None)).decode()
    assert "WARC-Type: resource" in other and "Content-Type: text/dns" in other


def test_records_carry_urls_dates_and_ids(spark):
    df = spark.createDataFrame([(1, "http://a/", "x" * 2000), (2, "http://b/", "x" * 2000)], "page_id long, url string, html string")
    warc = aw.convert(aw.write_arc(df.coalesce(1), date="20230405060708"))
    rows = {r.page_id: r for r in aw.read_warc(warc).collect()}
    assert rows[1].url == "http://a/" and rows[1].date == "2023-04-05T06:07:08Z"
    assert rows[1].refers_id == rows[2].record_id != rows[1].record_id
    file = warc.first()
    store, root = open_store(file.folder)
    text = gzip.decompress(store.open_input_file(f"{root}/{file.name}").read()).decode()
    assert text.count("WARC/1.1") == 3 and "WARC-Type: warcinfo" in text
    assert aw.REVISIT_PROFILE in text and text.count("x" * 2000) == 1


def foreign(version, *records, fields=None):
    """An archive as other writers leave it: fields of one line and the body of each record."""
    block = f"{version} 0 Elsewhere\n{fields or aw.FIELDS[version]}\n\n".encode()
    out = b"filedesc://x.arc 0.0.0.0 20010203040506 text/plain %d\n" % len(block) + block
    for line, body in records:
        out += f"{line} {len(body)}\n".encode() + body + b"\n"
    return out


@pytest.mark.parametrize("version", "12")
@pytest.mark.parametrize("url", ["http://x.org/", "http://x.org/a b/c  d?e=1.2.3.4 5", "dns:x.org"])
@pytest.mark.parametrize("kind", ["text/html", "text/html; charset=utf-8", "no-type", 'a/b; c="d e"; f=200'])
@pytest.mark.parametrize("address", ["1.2.3.4", "2001:db8::1"])
def test_header_lines_of_other_writers(version, url, kind, address):
    more = "" if version == "1" else " 302 a1b2 http://y.org/new place 77 x.arc"
    body = b"HTTP/1.0 200 OK\r\n\r\n<p>"
    line = f"{url} {address} 20010203040506 {kind}{more}"
    got = list(aw.arc_records(io.BytesIO(foreign(version, (line, body), (line, b"")))))
    assert [b for _, b in got] == [body, b""]
    for fields, data in got:
        assert (fields["url"], fields["ip-address"], fields["content-type"]) == (url, address, kind)
        assert fields["archive-date"] == "20010203040506" and int(fields["archive-length"]) == len(data)
        if version == "2":
            assert (fields["result-code"], fields["location"], fields["offset"]) == ("302", "http://y.org/new place", "77")


def test_header_lines_that_fit_no_version_raise():
    good = "http://x.org/ 1.2.3.4 20010203040506 text/html"
    assert len(list(aw.arc_records(io.BytesIO(foreign("1", (good, b"x")))))) == 1
    for bad in (
        "http://x.org/ 20010203040506 text/html",
        "http://x.org/ 1.2.3.4 text/html",
        "http://x.org/ 1.2.3.4 2001020304050 text/html",
        "http://x.org/",
    ):
        with pytest.raises(ValueError, match="bad header line"):
            list(aw.arc_records(io.BytesIO(foreign("1", (bad, b"x")))))
    with pytest.raises(ValueError, match="bad header line"):
        list(aw.arc_records(io.BytesIO(foreign("2", (good, b"x")))))
    # The archive's own list of fields counts, whatever their order.
    own = "URL Archive-date IP-address Archive-length"
    data = foreign("1", ("http://x.org/ 200102030405 1.2.3.4", b"xyz"), fields=own)
    ((fields, body),) = aw.arc_records(io.BytesIO(data))
    assert fields["archive-date"] == "200102030405" and body == b"xyz"


def test_dates_of_no_calendar_are_the_epoch():
    for digits in ("20011399000000", "20010230000000", "20010101250000", "20010101006000", "00000101000000", "200113"):
        assert aw.warc_date(digits) == aw.EPOCH, digits
    assert aw.warc_date("20000229235959") == "2000-02-29T23:59:59Z"


@pytest.mark.parametrize("length", ["", "Content-Length: 7\r\n"])
def test_a_revisits_length_is_that_of_its_response(spark, length):
    """Whatever the page's own HTTP header says, or if it has none."""
    page = b"<p>" + b"y" * 2000
    bodies = [
        f"HTTP/1.0 200 OK\r\n{length}{aw.ID_HEADER}: {i}\r\n\r\n".encode() + page for i in (1, 2)
    ]
    data = foreign("1", *[("http://x.org/ 1.2.3.4 20010203040506 text/html; charset=utf-8", b) for b in bodies])
    folder = aw.new_folder(spark, "foreign")
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/x.arc.gz", compression=None) as out:
        out.write(gzip.compress(data))
    archives = spark.createDataFrame([(folder, "x.arc.gz")], aw.ARCHIVES)
    found = aw.with_referred(aw.read_warc(aw.convert(archives))).orderBy("page_id").collect()
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.url) for r in found] == [
        (1, len(page), "revisit", 2, "http://x.org/"),
        (2, len(page), "response", None, "http://x.org/"),
    ]
