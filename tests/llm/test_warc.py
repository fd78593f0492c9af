from __future__ import annotations

import io

from sluiceway.llm import queries, warc
from sluiceway.llm.arrow import table
from sluiceway.session import fresh_dir
from tests.compare import mismatch, reference


def test_query_against_sql(spark, sf):
    got = queries.QUERIES["op8_warc_records"](spark, sf).toPandas().astype({"refers_to": "Int64"})
    want = reference(queries.ORACLES["op8_warc_records"], sf).astype({"refers_to": "Int64"})
    assert mismatch(got, want) is None


def test_odd_rows_and_split_reading(spark):
    nested = warc.record(1, "u", b"inner", None, False)
    rows = [(i, f"https://h.example/{i}", f"<p>{i % 7}</p>" * (i % 50)) for i in range(120)]
    rows += [(500, None, None), (501, "a\r\nb é", ""), (502, "u", "x" * 3_000_000), (None, "n", "only"), (503, "u", nested.decode()), (504, "u", "\x1f\x8b\x08" * 50)]
    pages = spark.createDataFrame([(i, u, h, "c", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, top int").repartition(3)
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    folder = fresh_dir(spark, "warc")
    manifest = warc.write(pages, folder)
    for split in (1 << 24, 700, 64):
        if split == 64:
            found = warc.read(spark, folder, manifest.where("bytes < 100000"), split)
            assert found.count() == warc.read(spark, folder, manifest.where("bytes < 100000")).count()
            continue
        got = {r.page_id: r for r in warc.read(spark, folder, manifest, split).collect()}
        assert len(got) == len(rows)
        for i, u, h in rows:
            r, data = got[i], (h or "").encode()
            top = last[h or ""]
            response = i == top or top < 0
            assert (r.url, r.payload_bytes, r.payload_digest) == (u, len(data), warc.digest(data))
            assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", top))
            assert (bytes(r.payload) if r.payload is not None else None) == (data if response else None)


def test_magic_inside_members_is_no_record():
    import gzip

    decoy = b"\x1f\x8b\x08 not a member " + gzip.compress(b"something else") + gzip.compress(b"WA")
    members = [gzip.compress(warc.record(i, "u", bytes([i]) * 50, None, False)) for i in range(5)]
    data = decoy + members[0] + b"\x1f\x8b\x08" + b"".join(members[1:])
    for width in (10, 37, 1000):
        found = [at for lo in range(0, len(data), width) for at, _ in warc.records(io.BytesIO(data), lo, min(lo + width, len(data)), len(data))]
        assert len(found) == len(set(found)) == 5


def test_small_payloads_are_not_compared(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    folder = fresh_dir(spark, "warc")
    got = {r.page_id: r.refers_to for r in warc.read(spark, folder, warc.write(pages, folder, revisit_from=3)).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
