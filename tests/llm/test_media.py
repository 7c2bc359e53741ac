"""Matroska files: round trips, all lacings, foreign structures, and the query's digests."""

import hashlib
import struct
import zlib

import pytest

from tessella.llm import media as M


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 2047, 2048, 40_000, 200_001])
def test_round_trip(n):
    text = ("aß漢" * n)[:n]
    payload = M.payload_of(text)
    assert len(payload) % 64 == 0 and len(payload) >= max(64, len(text.encode()))
    data = M.write(payload)
    m = M.parse(data)
    assert b"".join(data[p.start : p.end] for p in m.packets) == payload
    assert [p.timestamp for p in m.packets] == [8 * i for i in range(len(payload) // 64)]
    assert m.tracks[1]["codec"] == "A_PCM/INT/LIT" and m.doc_type == "matroska"
    assert len(m.cues) == m.clusters and all(M.read_vint(data, at)[1] == M.CLUSTER for _, _, at in m.cues)


@pytest.mark.parametrize("lacing", [M.XIPH, M.EBML_LACING])
def test_lacing_of_uneven_frames(lacing):
    frames = [b"a" * 3, b"b" * 700, b"c", b"d" * 255, b"e" * 510, b"f" * 9]
    body = M.lace(frames, lacing)
    at, sizes = M._lace_sizes(body, 0, len(body), lacing)
    assert sizes == [len(f) for f in frames] and body[at:] == b"".join(frames)


def test_block_groups_and_unknown_sizes():
    head = b"\x81" + struct.pack(">hB", 5, 0)
    group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, head + b"xyz") + M.unsigned(M.BLOCK_DURATION, 4))
    unknown = M.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + M.unsigned(M.CLUSTER_TIMESTAMP, 100) + group
    data = M.element(M.EBML, M.element(M.DOC_TYPE, b"webm")) + M.element(M.SEGMENT, unknown + unknown)
    m = M.parse(data)
    assert [(p.track, p.timestamp, data[p.start : p.end]) for p in m.packets] == [(1, 105, b"xyz")] * 2
    assert m.clusters == 2


def _segment(block):
    return M.element(M.EBML, M.element(M.DOC_TYPE, b"webm")) + M.element(M.SEGMENT, M.element(M.CLUSTER, M.element(M.SIMPLE_BLOCK, block)))


BAD = [b"\x00abc", b"\x1a\x45\xdf\xa3\x90ab", M.write(M.payload_of("abc"))[:-3], b"\x1a\x45\xdf\xa3", _segment(b"\x81\x00"), _segment(b"\x81\x00\x00\x02"), _segment(b"\x81\x00\x00\x02\x05\xff")]


@pytest.mark.parametrize("bad", BAD)
def test_malformed_files_are_refused(bad):
    with pytest.raises(ValueError):
        M.parse(bad)


def test_query(docs, odd, none):
    for table in (docs, odd):
        texts = [(r["doc_id"], r["text"] or "") for r in table.collect()]
        want = sorted((str(d), len(t.encode()), hashlib.sha256(M.payload_of(t)).hexdigest(), zlib.crc32(M.payload_of(t)[-64:]), hashlib.sha256(M.write(M.payload_of(t))).hexdigest()) for d, t in texts)
        rows = M.media_columns(table).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_sha256"]) for r in rows) == want
    assert M.media_columns(none).collect() == []


def test_a_bad_file_fails_alone(spark):
    good = M.write(M.payload_of("abc"))
    rows = M.packets(spark.createDataFrame([(i, b) for i, b in enumerate([*BAD, good, None])], "doc_id long, media binary").repartition(2)).collect()
    assert sorted((r["doc_id"], r["error"] is None) for r in rows) == [*((i, False) for i in range(len(BAD))), (len(BAD), True)]


def test_features_are_of_the_stored_file():
    payload, feature = M.describe(M.write(M.payload_of("ab" * 5000)))
    n, mean = len(payload) // 64, sum(payload) / len(payload)
    said = dict(p.split("=") for p in feature.split(";"))
    assert (int(said["packets"]), said["codec"], said["duration_ms"], said["mean"]) == (n, "A_PCM/INT/LIT", str(len(payload) // 8), f"{mean:.4f}")
    assert sum(map(int, said["lacing"].split("/"))) == n and said["clusters"] == said["cues"]


def test_packet_table(odd, none):
    rows = M.packets(M.store(odd.filter("doc_id = 1"))).collect()
    assert [(r["start"] < r["end"], r["track"]) for r in rows] == [(True, 1)]
    assert M.packets(M.store(none)).collect() == []
