import bz2
import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import tokens as K
from siftwork.operators.positions import zip_by_position
from siftwork.plans import quality_model as Q
from siftwork.sources import archive, files, token_stream, warc


def record(kind, payload, **headers):
    fields = {"WARC-Type": kind, **{k.replace("_", "-"): v for k, v in headers.items()}, "Content-Length": str(len(payload))}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + payload + b"\r\n\r\n"


def test_wet(spark, tmp_path):
    records = [
        record("warcinfo", b"software: x\r\n"),
        record("conversion", "Zeile eins\nZeile zwei\r\n\r\nnoch ä".encode(), WARC_Target_URI="http://a.example/1", WARC_Date="2026-01-02T03:04:05Z", WARC_Record_ID="<urn:1>"),
        record("conversion", b"bad \xff byte", WARC_Target_URI="http://a.example/2"),
        record("conversion", b""),
    ]
    (tmp_path / "a.warc.wet.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "b.warc.wet").write_bytes(b"".join(records[:2]))
    expected = [
        ("http://a.example/1", "2026-01-02T03:04:05Z", "<urn:1>", "Zeile eins\nZeile zwei\r\n\r\nnoch ä"),
        ("http://a.example/2", "", "", "bad � byte"), ("", "", "", ""),
    ]
    for exact in (False, True):
        got = warc.read_wet(spark, str(tmp_path / "a.warc.wet.gz"), exact=exact)
        rows = [(r["url"], r["date"], r["record_id"] if r["record_id"].startswith("<") else "", r["text"]) for r in got.collect()]
        assert sorted(rows) == sorted(expected)
        both = warc.read_wet(spark, str(tmp_path), exact=exact)
        assert {r["file"].rsplit("/", 1)[1]: r["n"] for r in both.groupBy("file").agg(F.count("*").alias("n")).collect()} == {
            "a.warc.wet.gz": 3, "b.warc.wet": 1,
        }


def test_separator_in_payload(spark, tmp_path):
    inner = record("conversion", b"inner")
    (tmp_path / "x.wet").write_bytes(record("conversion", b"text\r\n\r\n" + inner) + record("conversion", b"last"))
    with pytest.raises(Exception, match="record split by a separator"):
        warc.read_wet(spark, str(tmp_path / "x.wet")).collect()
    newer = tmp_path / "newer"
    newer.mkdir()
    (newer / "y.wet").write_bytes(b"".join(record("conversion", t).replace(b"WARC/1.0", b"WARC/1.1") for t in (b"one", b"two")))
    with pytest.raises(Exception, match="of another version"):
        warc.read_wet(spark, str(newer)).collect()
    assert [r["text"] for r in warc.read_wet(spark, str(newer), exact=True).collect()] == ["one", "two"]
    exact = warc.read_wet(spark, str(tmp_path / "x.wet"), exact=True)
    assert [r["text"] for r in exact.collect()] == ["text\r\n\r\n" + inner.decode(), "last"]


def test_many_tasks_read_one_archive(spark, tmp_path):
    """Members that begin in a range are read by its task, whatever the payloads hold."""
    rng = random.Random(1)
    inner = record("conversion", b"inner", WARC_Record_ID="<inner>")
    payloads = [rng.randbytes(rng.randrange(0, 3000)) + (b"\r\n\r\n" + inner + gzip.compress(inner)) * (i % 3) for i in range(200)]
    whole = [record("conversion", p, **({"WARC_Record_ID": f"<{i}>"} if i % 4 else {})) for i, p in enumerate(payloads)]
    members = [gzip.compress(r, 1) for r in whole[:150]] + [gzip.compress(b"".join(whole[150:180]))]
    cut = b"".join(whole[180:])
    members += [gzip.compress(cut[:1000]), gzip.compress(cut[1000:5000]), gzip.compress(cut[5000:])]  # records across members
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    (tmp_path / "b.warc").write_bytes(b"".join(whole))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    for split in (1000, 20_000, 1 << 30):
        df = archive.read_archive(spark, str(tmp_path), split)
        rows = df.collect()
        for name in ("a.warc.gz", "b.warc"):
            mine = [r for r in rows if r["file"].endswith(name)]
            assert sorted(bytes(r["payload"]) for r in mine) == sorted(payloads)
            assert len({r["record_id"] for r in mine}) == 200 and sum("@" in r["record_id"] for r in mine) == 50
            assert {r["record_id"] for r in mine} == {r["record_id"] for r in archive.read_archive(spark, str(tmp_path / name)).collect()}
        if split == 1000:
            assert df.rdd.getNumPartitions() > 100
    nested = b"".join(gzip.compress(record("conversion", rng.randbytes(300))) for _ in range(60))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(gzip.compress(record("resource", nested if i == 5 else b"x"), 0) for i in range(9)))
    for split in (100, 1500):  # whole archives inside a payload look like members: their ranges are not proven
        rows = archive.read_archive(spark, str(tmp_path / "c.warc.gz"), split).collect()
        assert sorted(bytes(r["payload"]) for r in rows) == sorted([b"x"] * 8 + [nested])
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members)[:-30])
    with pytest.raises(Exception, match="ends inside"):
        archive.read_archive(spark, str(tmp_path / "a.warc.gz"), 20_000).collect()


def test_responses(spark, tmp_path):
    def http(status, body, content_type="text/html; charset=utf-8"):
        return f"HTTP/1.1 {status} X\r\nContent-Type: {content_type}\r\n\r\n".encode() + body

    page = "<html><head><title>t</title></head><body><p>Grüße &amp; mehr</p></body></html>"
    data = b"".join(
        gzip.compress(record(kind, payload, WARC_Target_URI=f"http://a.example/{i}"))
        for i, (kind, payload) in enumerate([
            ("request", b"GET / HTTP/1.1\r\n\r\n"),
            ("response", http(200, page.encode())),
            ("response", http(404, b"gone")),
            ("response", http(200, b"%PDF", "application/pdf")),
            ("response", http(200, page.encode("cp1252"), "TEXT/HTML")),
            ("response", http(200, b"<p> </p>")),
            ("response", b"no headers"),
        ])
    )
    (tmp_path / "r.warc.gz").write_bytes(data)
    for exact in (False, True):
        found = Q.responses_to_texts(warc.read_responses(spark, str(tmp_path / "r.warc.gz"), exact=exact))
        got = {r["url"][-1]: (r["reason"], r["text"] if r["reason"] is None else None) for r in found.collect()}
        assert got == {
            "1": (None, "Grüße & mehr"), "2": ("http_404", None), "3": ("non_html", None), "4": (None, "Grüße & mehr"),
            "5": ("empty", None), "6": ("no_http_headers", None),
        }


def test_curated_json(spark, tmp_path):
    row = ("http://a.example", "a.example", "2026", "<urn:1>", 2, "schöner Text\nzwei")
    path = str(tmp_path / "out")
    files.write_curated(spark.createDataFrame([row], files.CURATED).coalesce(1), path)
    [part] = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".json"]
    assert "schöner" in part.read_text() and list(json.loads(part.read_text())) == files.CURATED.names
    assert tuple(files.read_curated(spark, path).drop(*files.LINE_ORDER).first()) == row
    many = spark.range(500).select(F.lit("").alias("url"), F.format_string("%04d", "id").alias("text")).repartition(3).sortWithinPartitions("text")
    many.write.json(str(tmp_path / "many"))
    lines = [line for p in sorted((tmp_path / "many").glob("*.json")) for line in p.read_text().splitlines()]
    read = files.read_curated(spark, str(tmp_path / "many")).orderBy(*files.LINE_ORDER).select("text").collect()
    assert [r["text"] for r in read] == [json.loads(line)["text"] for line in lines]
    (tmp_path / "out" / "more.json").write_text('{"text": \n')
    broken = files.read_curated(spark, path, "PERMISSIVE").cache().where("_corrupt_record IS NOT NULL")
    assert broken.count() == 1
    with pytest.raises(Exception):
        files.read_curated(spark, path).collect()


def test_lists_dumps_and_folders(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(" http://b.example \n\nhttp://a.example\n")
    assert [r["value"] for r in files.read_lines(spark, str(tmp_path / "urls.txt")).collect()] == ["http://b.example", "http://a.example"]
    (tmp_path / "wet.paths.gz").write_bytes(gzip.compress(b"p/1.gz\np/2.gz\n"))
    assert files.read_path_listing(spark, str(tmp_path / "wet.paths.gz")).count() == 2
    dump = "x &lt;ref&gt;http://z.example/1 and http://z.example/1 &lt;/ref&gt;\nnone\n".encode() + b"\xff\n"
    (tmp_path / "dump.bz2").write_bytes(bz2.compress(dump))
    found = files.read_dump_urls(spark, str(tmp_path / "dump.bz2"))
    assert found.count() == 2 and [r["url"] for r in files.distinct_urls(found, found).collect()] == ["http://z.example/1"]
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.txt").write_text("one\ntwo\n")
    (folder / "b.txt").write_text("")
    docs = files.read_document_folder(spark, str(folder))
    assert sorted(map(tuple, docs.collect())) == [("a.txt", "one\ntwo\n"), ("b.txt", "")]
    exact = [("a", "one\ntwo\n"), ("b", ""), ("c", "one\ntwo"), ("d", None), ("e", "\n"), ("f", "x\r\ny\u2028")]
    files.write_documents(spark.createDataFrame(exact, "name string, text string"), str(tmp_path / "out"))
    found = {r["name"]: bytes(r["content"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {n: (t or "").encode() for n, t in exact}
    assert {tuple(r) for r in files.read_documents(spark, str(tmp_path / "out")).collect()} == {(n, t or "") for n, t in exact}
    lines = spark.createDataFrame([("train", "__label__wiki good text"), ("valid", "__label__cc")], "split string, line string")
    files.write_labelled(lines, str(tmp_path / "set"))
    assert sorted(map(tuple, files.read_labelled(spark, str(tmp_path / "set" / "*")).collect())) == [("cc", ""), ("wiki", "good text")]


def test_token_stream(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} and the end" if i % 7 else "") for i in range(40)], "doc_id long, text string").repartition(5)
    vocabulary = K.build_vocabulary(docs, size=4)
    tokenized = K.tokenize(docs, vocabulary).cache()
    rows = {r["doc_id"]: r["tokens"] for r in tokenized.collect()}
    assert rows[0] == [K.EOS_ID] and all(t[-1] == K.EOS_ID for t in rows.values()) and ord("1") in rows[1]
    back = {r["doc_id"]: r["text"] for r in K.detokenize(tokenized, vocabulary).collect()}
    assert back == {r["doc_id"]: r["text"] for r in docs.collect()}
    stream = [t for i in sorted(rows) for t in rows[i]]
    token_stream.write_token_stream(tokenized, ["doc_id"], str(tmp_path / "bin"))
    assert all(p.name.startswith("part-") for p in (tmp_path / "bin").iterdir())
    with pytest.raises(FileExistsError):
        token_stream.write_token_stream(tokenized, ["doc_id"], str(tmp_path / "bin"))
    read = sorted(token_stream.read_token_stream(spark, str(tmp_path / "bin")).collect(), key=lambda r: r["part"])
    assert [t for r in read for t in r["tokens"]] == stream
    lengths = tokenized.select("doc_id", F.size("tokens").alias("n_tokens"))
    offsets = K.token_offsets(lengths, ["doc_id"])
    position, expected = 0, {}
    for i in sorted(rows):
        expected[i] = position
        position += len(rows[i])
    assert {r["doc_id"]: r["offset"] for r in offsets.collect()} == expected
    packed = {r["seq_id"]: (r["x"], r["y"]) for r in K.pack_sequences(tokenized, offsets, window=16).collect()}
    assert packed == {
        s: (stream[:-1][16 * s : 16 * s + 16], stream[16 * s + 1 : 16 * s + 17]) for s in range(-(-(len(stream) - 1) // 16))
    }
    bad = F.when(F.col("doc_id") == 39, F.array(F.lit(70_000))).otherwise(F.col("tokens"))
    with pytest.raises(Exception, match="outside 0..65535"):
        token_stream.write_token_stream(tokenized.select("doc_id", bad.alias("tokens")), ["doc_id"], str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists() or not list((tmp_path / "bad").iterdir())  # a failed job leaves no part


def test_quarantine(spark):
    page = b"<p>text</p>"
    rows = [
        (1, 200, "text/html", page), (2, 404, "text/html", page), (3, None, None, None), (4, 200, "image/png", page), (5, 200, "TEXT/html", b""),
        (6, 200, "text/html", None), (7, 200, "text/html", b"<meta charset=hex>\xff"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, status int, content_type string, body binary")
    found = Q.quarantine(Q.responses_to_texts(df))
    assert [tuple(r) for r in found.good.collect()] == [(1, "text")]
    reasons = {r["doc_id"]: (r["reason"], r["error"] is not None) for r in found.bad.collect()}
    assert reasons == {
        2: ("http_404", False), 3: ("no_http_headers", False), 4: ("non_html", False), 5: ("empty", False), 6: ("errors", True),
        7: ("errors", True),
    }
    counted = {r["reason"]: r["n"] for r in found.counters.collect()}
    assert counted == {"seen": 7, "kept": 1, "http_404": 1, "no_http_headers": 1, "non_html": 1, "empty": 1, "errors": 2}


def test_zip_by_position(spark):
    left = [(i, k) for i, k in enumerate("abcdefaa")]
    right = [(i * 10, k) for i, k in enumerate("abdcxfa")]
    sides = [spark.createDataFrame(rows, "at long, key string").repartition(3) for rows in (left, right)]
    got = [tuple(r) for r in zip_by_position(*sides, "key", ["at"]).orderBy("position").collect()]
    assert got == [
        (0, "a", "a", "equal", "equal"), (1, "b", "b", "equal", "equal"), (2, "c", "d", "moved", "moved"), (3, "d", "c", "moved", "moved"),
        (4, "e", "x", "missing", "missing"), (5, "f", "f", "equal", "equal"), (6, "a", "a", "equal", "equal"), (7, "a", None, "moved", None),
    ]
