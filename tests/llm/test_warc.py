import base64
import hashlib

from cases import pages

from tidemark.llm import catalog, warc


def expect(rows):
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), i)
    out = []
    for i, _, h in rows:
        data, keep = (h or "").encode(), best[h or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if keep == i else "revisit", None if keep == i else keep))
    return sorted(out)


def got(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(catalog.op4_warc(spark, sf_small)) == expect(rows)


def test_awkward_rows_in_both_forms(spark, tmp_path):
    rows = [(1, None, None), (2, "http://a b\r\nX: y/é", ""), (3, "u", "same\r\n\r\nWARC/1.1\r\n"), (4, "u", "same\r\n\r\nWARC/1.1\r\n"),
            (5, "u", "é🙂\0" * 1000), (6, "u", "x" * 300_000), (7, "u", "x" * 300_000)]
    table = pages(spark, rows)
    for compress in (True, False):
        path = str(tmp_path / f"{compress}")
        warc.write_archives(table, path, archive_bytes=1000, compress=compress)
        back = warc.read_archives(spark, path, with_payload=True)
        assert back.where("gap_reason IS NOT NULL").count() == 0
        assert got(back) == expect(rows)
        assert {r.page_id: bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()} \
            == {i: (h or "") for i, _, h in rows if i in (2, 4, 5, 7)}
    small = str(tmp_path / "min")
    warc.write_archives(table, small, min_bytes=100)
    assert {r.page_id for r in warc.read_archives(spark, small).where("record_type = 'revisit'").collect()} == {6}
    warc.write_archives(pages(spark, []), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    warc.write_archives(pages(spark, [(None, None, "a"), (None, "u", "a"), (1, "u", "a"), (1, "u", "a")]), str(tmp_path / "ids"))
    assert sorted((r.record_type, r.refers_to) for r in warc.read_archives(spark, str(tmp_path / "ids")).collect()) \
        == [("response", None), ("response", None), ("revisit", 1), ("revisit", 1)]


def names(data):
    return [(h or {}).get("warc-record-id") if h else (s, e) for s, e, h, _, _ in warc.salvage(data)]


def test_salvage():
    records = [warc.page_record(i, "http://x", bytes([65 + i]) * 50 * (i + 1)) for i in range(6)]
    for pack in (warc.gzip_member, bytes):
        parts = [pack(r) for r in records]
        ends = [sum(map(len, parts[:k + 1])) for k in range(6)]
        whole = b"".join(parts)
        all_names = [f"<urn:page:{i}>" for i in range(6)]
        assert names(whole + b"\0\0") == all_names
        # A changed byte in record 2's payload: only that record is lost.
        bad = bytearray(whole)
        bad[ends[2] - 8] ^= 0xFF
        assert names(bytes(bad)) == [*all_names[:2], (ends[1], ends[2]), *all_names[3:]]
        # Junk between records, a cut at the end, junk alone.
        assert names(parts[0] + b"junk\n" + parts[1]) == [all_names[0], (ends[0], ends[0] + 5), all_names[1]]
        assert names(whole[:-7]) == [*all_names[:5], (ends[4], len(whole) - 7)]
        cut = whole[3:]  # zero bytes at its start are padding
        assert names(cut) == [(len(cut) - len(cut.lstrip(b"\0")), ends[0] - 3), *all_names[1:]]
        assert names(b"nothing here") == [(0, 12)] and names(b"") == []
    # A wrong length is a failed check; the following record is found by its version line.
    broken = records[1].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 2)
    assert names(records[0] + broken + records[2])[0] == "<urn:page:0>" and names(records[0] + broken + records[2])[-1] == "<urn:page:2>"
