import glob
import hashlib
import io
from collections import Counter

import pytest
import zstandard

from tramline.llm import warc
from tramline.session import scratch_dir

SCHEMA = "page_id LONG, url STRING, html STRING, digest STRING, refers_to LONG"


@pytest.fixture(scope="module")
def pages(spark):
    big, small = "<p>é漢</p>" * 30, "tiny"
    rows = [(i, f"http://a/{i}", big) for i in (7, 3, 9, 12)] + [(i, None, small) for i in (20, 21)]
    rows += [(30, "u\r\nX: y", ""), (31, "u", None), (None, "u", big), (None, "u", "z" * 200), (-4, "u", "y" * 100)]
    rows += [(-9, "u", "y" * 100), (40, "u", "y" * 99), (41, "u", "y" * 99), (3, "again", big), (50, "u", "é" * 400_000)]
    rows += [(100 + i, "u", f"<p>{i}</p>" * 50) for i in range(60)]
    return spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(3), rows


def brute(rows):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        head = least.get(html or "")
        again = len(raw) >= 100 and head is not None and i != head
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("bundle_bytes", [3000, 32 << 20])
def test_round_trip(spark, pages, bundle_bytes):
    df, rows = pages
    folder = scratch_dir(spark, "test-warc")
    index = warc.write_archives(df, folder, bundle_bytes).collect()
    assert sorted(map(tuple, warc.read_archives(spark, folder).collect()), key=str) == brute(rows)
    assert Counter(r.page_id for r in index) == Counter(i for i, _, _ in rows)
    by_id = {i: html for i, _, html in rows}
    for r in index:
        raw = open(f"{folder}/bundles/{r.bundle}".removeprefix("file://"), "rb").read()
        headers, body = warc.parse(warc.Reader(raw).read(r.frame, r.offset, r.length))
        assert headers["WARC-Record-ID"] == f"<urn:page:{'' if r.page_id is None else r.page_id}>"
        if headers["WARC-Type"] == "response" and r.page_id is not None:
            assert body.decode() == (by_id[r.page_id] or "")


def test_any_tool_reads_a_bundle_as_one_stream(spark, pages):
    df, rows = pages
    folder = scratch_dir(spark, "test-warc")
    warc.write_archives(df, folder).count()
    records = 0
    for name in glob.glob(f"{folder}/bundles/*.zst".replace("file://", "")):
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(name, "rb").read()), read_across_frames=True)
        records += plain.read().count(b"WARC/1.1\r\n")
    assert records == len(rows)


def test_empty(spark, pages):
    folder = scratch_dir(spark, "test-warc")
    warc.write_archives(pages[0].where("page_id = 999"), folder)
    assert warc.read_archives(spark, folder).collect() == []
