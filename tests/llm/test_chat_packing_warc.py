"""Round trips of chat formatting, packing and WARC archives."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapwise.llm import warc
from lapwise.llm.chat import CONTROL, END, SEPARATOR, START, chat_events, escape, fold_messages, format_chats, unescape
from lapwise.llm.packing import Capacity, best_fit, pack
from lapwise.llm.queries import QUERIES, tokenizer_path

LOG = "conv_id long, message long, seq long, kind string, role string, text string"


def test_fold(spark):
    log = [
        (1, 1, 1, "delta", "user", "He"), (1, 1, 2, "delta", None, "llo"), (1, 1, 3, None, None, "!"),
        (1, 2, 4, "delta", "assistant", "bad"), (1, 2, 5, "regenerate", None, "go"), (1, 2, 6, "delta", None, "od"),
        (1, 3, 7, "delta", "user", "typo"), (1, 3, 9, "edit", None, "fixed"), (1, 3, 8, "delta", None, " lost"),
        (2, 1, 1, "regenerate", "assistant", None), (None, None, None, None, None, None), (3, 1, 1, "edit", "a", "x"),
        (3, 1, 2, "edit", "b", "y"), (3, 1, 2, "delta", "b", "z"),
    ]
    random.Random(1).shuffle(log)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in fold_messages(spark.createDataFrame(log, LOG)).collect()}
    assert got == {
        (1, 1): ("user", "Hello!"), (1, 2): ("assistant", "good"), (1, 3): ("user", "fixed"), (2, 1): ("assistant", ""),
        (None, None): ("", ""), (3, 1): ("a", "y"),
    }


def test_chats_read_back(spark):
    rng = random.Random(2)
    parts = [*CONTROL, "\\", "\\\\", "é", "\n", " ", "x", "<", "|", "[", "", "$1", "𝒳"]
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb" + START, None]), rng.choice([None, "".join(rng.choices(parts, k=8))])) for c in range(40) for t in range(5)]
    rows += [(99, 1, "user", "b"), (99, 1, "user", "a"), (99, 1, "assistant", "c"), (99, 1, "user", "a"), (None, None, "user", "n"), (98, 0, "assistant", "long " * 40_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, message string").repartition(5)
    kinds = {r.kind: r["count"] for r in chat_events(df).groupBy("kind").count().collect()}
    assert set(kinds) == {"delta", "edit", "regenerate"} and min(kinds.values()) >= 30
    for r in format_chats(chat_events(df)).collect():
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in own]
        assert r.learned == "".join(text for _, role, text in own if role == "assistant")
        assert r.formatted.count(START) == r.formatted.count(END) == r.formatted.count(SEPARATOR) == len(own)
        assert not any(c in r.formatted for c in CONTROL[3:])
        for piece, span in zip(r.formatted.split(START)[1:], r.loss, strict=True):
            whole = START + piece
            assert span.length == 0 or whole[span.start - len(SEPARATOR) : span.start] == SEPARATOR
            assert span.length == 0 or whole[span.start + span.length :].startswith(END)
    assert format_chats(chat_events(df.limit(0))).count() == 0


def test_escape_is_reversible(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices([*CONTROL, "\\", "<", "s", ">", "|", "\n"], k=6)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u and not any(c in r.e for c in CONTROL) for r in out)


def check_packing(out, docs, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    by_sequence, pieces = {}, {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append(r)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity.tokens and len(rows) <= capacity.limits[1]
        assert sum(r.length**2 for r in rows) <= capacity.limits[2]
    for i, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted(pieces[i], key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity.tokens)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [Capacity(64), Capacity(64, documents=2, rule="dot"), Capacity(64, attention=4096, weights=(1, 1, 1))])
def test_packing(spark, capacity):
    rng = random.Random(4)
    docs = {i: " ".join(rng.choice(["a", "naïve", "The", "x1", "end."]) for _ in range(rng.choice([0, 3, 9, 30, 200]))) for i in range(120)}
    docs |= {200: None, 201: "", 202: "z " * 5000}
    df = spark.createDataFrame([(i, t, 5, 6) for i, t in docs.items()], "doc_id long, text string, length int, uid int")
    out = pack(df, tokenizer_path(), capacity, group_pieces=150).collect()
    used = check_packing(out, docs, capacity)
    if capacity.documents is None and capacity.attention is None:
        assert used <= sum(r.length for r in out) / 64 + 3


def test_packing_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (1, None)], "doc_id long, text string")
    out = pack(df, tokenizer_path(), Capacity(8), keep_ids=True).collect()
    assert len(out) == 4 and sorted((r.offset, r.length) for r in out)[0][0] == 0
    assert all(list(r.ids)[-1] == 0 and len(r.ids) == r.length for r in out)
    assert pack(df.limit(0), tokenizer_path()).count() == 0
    for bad in ({"tokens": 0}, {"tokens": 8, "attention": 9}, {"rule": "first"}, {"documents": 0}):
        with pytest.raises(ValueError):
            Capacity(**bad)


def test_whole_documents_are_packed(spark, sf_dir, sf_documents):
    out = QUERIES["op6_best_fit_packing"](spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in sf_documents.collect()}
    used = check_packing(out, docs, Capacity(2048))
    assert used <= 1.02 * sum(r.length for r in out) / 2048 + 1


def test_best_fit_chooses_the_tightest():
    sequence, offset = best_fit(np.array([6, 5, 4, 3, 2]), Capacity(10))
    assert sequence.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]
    assert best_fit(np.zeros(0, dtype=np.int64), Capacity(10))[0].tolist() == []


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", None, "", "é" * 10, "<p>a</p>", "x\r\n\r\nWARC/1.1\r\n", "<p>a</p>", "big " * 300_000]
    rows = [(10 - i, f"http://h/{i}\r\nx: y é", h, "clash") for i, h in enumerate(html)] + [(None, None, "<p>a</p>", ""), (None, "u", "only", ""), (4, "again", "<p>a</p>", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, size string").repartition(3)
    files = warc.write_archives(pages, str(tmp_path / "w"), file_bytes=2_000)
    out = warc.read_archives(files, str(tmp_path / "w"), keep_payload=True).collect()
    assert len(out) == len(rows)
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    by = {}
    for r in out:
        by.setdefault((r.page_id, r.url), []).append(r)
    for i, url, h, _ in rows:
        payload = (h or "").encode()
        (r,) = by[(i, url or "")]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        smallest = first.get(h or "")
        if i == smallest:
            assert (r.record_type, r.refers_to, r.payload) == ("response", None, payload)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", smallest, None)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")], "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.archive_pages(pages, least_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def chunks(data, size):
    return (data[i : i + size] for i in range(0, len(data), size))


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_reader_frames_members(size):
    records = [warc.page_record(i, "u", b"p" * i, i, warc.digest_of(b"p" * i), None) for i in range(5)]
    data = b"".join(warc.member(r) for r in records)
    assert data.startswith(b"\x1f\x8b")
    got = [warc.http_payload(r.block)[1] for r in warc.read_records(chunks(data, size))]
    assert got == [b"p" * i for i in range(5)]


def test_reader_refuses_broken_archives():
    good = warc.page_record(1, "u", b"body", 4, warc.digest_of(b"body"), None)
    size = len(good.partition(b"\r\n\r\n")[2]) - 4
    longer = good.replace(f"Content-Length: {size}".encode(), f"Content-Length: {size + 1}".encode())
    assert longer != good
    for record in (good.replace(b"body", b"bodx"), good[:-1], good.replace(b"WARC/1.1", b"NOPE/1.1"), longer, b""):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(iter([warc.member(record)])))
    for data in (warc.member(good)[:-5], b"no gzip at all", warc.member(good) + b"rest"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(iter([data])))
    assert list(warc.read_records(iter([]))) == []
