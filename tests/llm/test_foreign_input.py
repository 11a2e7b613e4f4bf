"""Texts of other planes, very long texts, and archives of other writers."""

import gzip

import numpy as np
import pytest

from amperine.llm import language, warc
from amperine.llm.common import by_text, labelled_texts, pieces
from amperine.llm.tokens import LETTER, SIGN, spell, tokens


def test_kinds_of_characters_follow_python_in_every_plane():
    text = "a1 😀𝒜𐐀𐐨𝟙🀄é"
    kinds, codes, upper, _ = spell([text])
    for c, kind, code, raised in zip(text, kinds[1:], codes[1:], upper[1:]):
        assert (kind == LETTER) == c.isalpha() and raised == c.isupper() and chr(code) == c.lower()
    assert kinds[1 + text.index("😀")] == SIGN and len(tokens(["𐐀𐐨"]).hash) == 1


def test_texts_without_letters_are_unknown(spark):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(40)] + [(100 + i, "der hund und die katze " * 5, "de") for i in range(40)]
    rows += [(300, "😀😀 😀", None), (301, "🀄 12 !?", None), (302, None, None), (303, "", None), (304, "the 😀 cat", None)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(got) == 85 and all(got[i].lang_pred == "und" and got[i].rejected for i in (300, 301, 302, 303))
    assert got[304].lang_pred == "en" and all(got[i].lang_pred == ("en" if i < 100 else "de") for i, *_ in rows[:80])


def test_long_texts_are_cut_at_blanks_only():
    words = [f"w{i}" for i in range(3000)] + ["x" * 5000] + ["end"]
    text = "\n".join(words)
    parts = list(pieces(text, 700))
    assert "".join(parts) == text and [w for p in parts for w in p.split()] == words
    count = lambda texts: np.array([[len(t.split())] for t in texts])
    got = np.concatenate([np.atleast_2d(x) for x in by_text([None, text, "a b"], count, chars=700)])
    assert got.ravel().tolist() == [0, 3002, 2]


def http(body, *fields):
    return "\r\n".join(["HTTP/1.1 200 OK", *fields]).encode() + b"\r\n\r\n" + body


def foreign(kind, block, *fields, length=True):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}-{len(block)}>", *fields]
    lines += [f"Content-Length: {len(block)}"] if length else []
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


@pytest.mark.parametrize("range_bytes", [1 << 20, 40])
def test_records_of_other_writers_are_read(spark, tmp_path, range_bytes):
    response = "Content-Type: application/http; msgtype=response"
    good = "WARC-Payload-Digest: sha1:" + warc.payload_digest(b"hello")
    chunked = http(b"3\r\nhel\r\n2;x=y\r\nlo\r\n0\r\n\r\n", "Transfer-Encoding: chunked")
    data = b"".join([
        foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request"),
        foreign("response", http(b"hello"), response, "WARC-Target-URI: http://a/"),
        foreign("response", chunked, response, good),
        foreign("response", http(b"12345678", "content-length: 8"), response, "WARC-Payload-Digest: md5:abc"),
        foreign("metadata", b"k: v", length=False),
        foreign("revisit", http(b""), response, "WARC-Refers-To: <urn:uuid:1>"),
        foreign("resource", b"", "Content-Type: text/plain"),
    ])
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data))], "file string, bytes long")
    rows = warc.read(spark, files, range_bytes, with_payload=True).orderBy("start").collect()
    assert [(r.record_type, r.payload_bytes, r.payload_digest) for r in rows] == [
        ("warcinfo", 13, None), ("request", 0, None), ("response", 5, None), ("response", 5, warc.payload_digest(b"hello")),
        ("response", 8, "abc"), ("metadata", 4, None), ("revisit", None, None), ("resource", 0, None),
    ]
    assert bytes(rows[3].payload) == b"hello" and rows[2].uri == "http://a/" and rows[6].refers == "urn:uuid:1"
    assert rows[0].page == "urn:uuid:warcinfo-13"


def test_a_payload_unlike_its_digest_stops_the_job(spark, tmp_path):
    block = foreign("response", http(b"hello"), "Content-Type: application/http", "WARC-Payload-Digest: sha1:" + warc.payload_digest(b"other"))
    (tmp_path / "a.warc.gz").write_bytes(block)
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), len(block))], "file string, bytes long")
    with pytest.raises(Exception, match="not the one that was written"):
        warc.read(spark, files).collect()


def test_a_key_of_many_rows_is_one_row_of_a_sample(spark):
    docs = spark.createDataFrame(
        [(7, f"text {i % 90:02d}", "x") for i in range(900)] + [(8, None, "x"), (9, "b", "x"), (None, "c", "x")],
        "doc_id long, text string, label string",
    )
    marks = spark.createDataFrame([(7, 1), (8, 0), (10, 1)], "doc_id long, label int")
    got = labelled_texts(docs, marks, "doc_id", "text")
    assert sorted((r.doc_id, r.label, r.text) for r in got.collect()) == [(7, 1, "text 00"), (8, 0, None)]
