import base64
import hashlib

import pytest

from coursemill.llm.warc import END, MAGIC, archive_pages

FAKE = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello" + END


def rows():
    out = [(i, f"u{i}", "x" * (i % 50) + FAKE * (i % 4) + "é\r\n" * (i % 7) + MAGIC * (i % 3)) for i in range(150)]
    out += [(None, None, None), (900, "a\r\nb", ""), (901, "q", None), (3, "u3", "xxx" + FAKE * 3 + "é\r\n" * 3), (903, "l", "long " * 40_000)]
    return out + [(910 + i, "z", FAKE.replace("5", "99999999")) for i in range(5)]


def brute(pages, least_bytes=0):
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        to = first.get(html or "") if len(raw) >= least_bytes else None
        to = None if to == page else to
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 60])
@pytest.mark.parametrize("split", [None, "2500"])
def test_round_trip_rejects_records_inside_payloads(spark, least, split):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        if split:
            spark.conf.set(names[0], split), spark.conf.set(names[1], "16")
        df = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr("*", "1 as at", "2 as least", "3 as kind")
        out = archive_pages(df, least, records_per_file=60)
        assert sorted(map(tuple, out.collect()), key=str) == brute(rows(), least)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
