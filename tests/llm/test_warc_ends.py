"""End records beside look-alikes, and ids that look like others."""

import io
import zipfile

import pyarrow as pa
import pytest

from palimpsest.llm import warc_zip
from palimpsest.llm.common import new_dir


@pytest.mark.parametrize("note", [b"", b"PK\x05\x06", b"a PK\x05\x06 stands here" + bytes(30), b"PK\x05\x06" * 9, b"x" * 65535])
def test_end_record_beside_its_signature_in_the_comment(note):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as f:
        f.writestr("a", b"PK\x05\x06 stored")
        f.comment = note
    raw = out.getvalue()
    assert warc_zip.ZipDirectory(pa.BufferReader(raw), len(raw)).read("a") == b"PK\x05\x06 stored"


def test_string_ids_come_back_as_they_were(spark):
    rows = [("null", "u", "one"), (None, "u", "two"), ("", "u", "three"), ("a b%/é<>", "u", "four"), ("null", "u", "four"), ("urn:x-no-page", "u", "five")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = warc_zip.read_packages(warc_zip.write_packages(df, new_dir(spark, "w")), "string").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["refers_to"]) for r in got), key=str) == sorted([("null", 3, None), (None, 3, None), ("", 5, None), ("a b%/é<>", 4, None), ("null", 4, "a b%/é<>"), ("urn:x-no-page", 4, None)], key=str)
