import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapwright.llm import packing, records
from snapwright.llm.tokens import TextEncoder, narrow, public_vocabulary, widen

ENCODER = TextEncoder(public_vocabulary(), remembered=50)
ALPHABET = st.text(st.characters(exclude_categories=("Cs",)) | st.sampled_from(list(" \n\t.,'sSΣσ\x01\x85\x1c0aÉ<|>")), max_size=60)


def plain(text):
    return ENCODER.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=4))
def test_words_give_the_ids_of_the_whole_text(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("text", ["it's 'S x'll", "a<|endoftext|>b", "é É.", "İstanbul, ΣΑΣ.", "a.. b., c.", "Ω Å,"])
def test_awkward_words(text):
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == plain(text)


def test_width_round_trip():
    ids = np.array([0, 1, 49_407], "<u4").tobytes()
    assert widen(narrow(ids, 2), 2) == ids and widen(narrow(ids, 4), 4) == ids


def expected_records(df):
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()), key=lambda r: r[:2])
    return [(i if known else None, [*plain(t), 2]) for known, i, t in rows]


def test_records_round_trip(spark, awkward, tmp_path):
    folder = f"file://{tmp_path}/rec"
    index = records.write_records(awkward, folder, file_bytes=50_000)
    got = records.read_records(spark, folder).orderBy("start").collect()
    want = expected_records(awkward)
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    assert sorted(map(str, (np.frombuffer(r["ids"], "<u4").tolist() for r in got))) == sorted(str(ids) for _, ids in want)
    at = 0
    for row in got:
        assert row["start"] == at and row["ids_crc32"] == zlib.crc32(row["ids"])
        at += row["n_tokens"]
    for row in index.collect():
        doc_id, ids = records.read_record(folder, row["file"], row["position"])
        assert doc_id == row["doc_id"] and len(ids) == row["n_tokens"]
    assert index.select("file").distinct().count() > 1


def test_records_of_nothing(spark, awkward, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert records.write_records(awkward.limit(0), folder).count() == 0
    assert records.read_records(spark, folder).count() == 0


def test_damaged_records_are_refused(tmp_path):
    good = records.frame(b"payload")
    for at in (0, 9, 14, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        path = tmp_path / f"bad-{at}"
        path.write_bytes(bytes(bad))
        with path.open("rb") as opened, pytest.raises(ValueError):
            records.read_frame(opened)
    path = tmp_path / "cut"
    path.write_bytes(good[:-2])
    with path.open("rb") as opened, pytest.raises(ValueError):
        records.read_frame(opened)
    assert struct.unpack("<Q", good[:8])[0] == 7


def exact_bins(lengths, capacity):
    """Fewest bins by trying everything; for a handful of lengths."""
    best = [len(lengths)]

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= lengths[at] and bins[i] not in bins[:i]:
                place(at + 1, [*bins[:i], bins[i] - lengths[at], *bins[i + 1 :]])
        place(at + 1, [*bins, capacity - lengths[at]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_and_best_fit_enclose_the_optimum(lengths):
    lengths = sorted(lengths, reverse=True)
    optimum = exact_bins(lengths, 20)
    bins, offsets, left = packing.best_fit_decreasing(np.array(lengths), 20)
    assert packing.lower_bound(np.array(lengths), 20) <= optimum <= len(left)
    for b in range(len(left)):
        own = sorted((o, n) for o, n, c in zip(offsets, lengths, bins, strict=True) if c == b)
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own][:-1]]).tolist()
        assert sum(n for _, n in own) == 20 - left[b]


def test_bound_sees_more_than_the_sum():
    assert packing.lower_bound(np.full(9, 11), 20) == 9
    assert packing.lower_bound(np.full(9, 7), 20) == 5


def check_sequences(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_awkward(awkward):
    rows = packing.pack(awkward, capacity=64).collect()
    check_sequences(rows, 64)
    got, want = {}, {}
    for r in rows:
        key = (r["doc_id"], r["uid"] - r["piece"])
        got.setdefault(key, []).append((r["piece"], r["start"], np.frombuffer(r["ids"], f"<u{r['id_bytes']}").tolist()))
    for pieces in got.values():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces))) and all(s == 64 * p for p, s, _ in pieces)
        assert all(len(ids) == 64 for _, _, ids in pieces[:-1])
    texts = sorted((str(k[0]), sum((ids for _, _, ids in v), [])) for k, v in got.items())
    want = sorted((str(r["doc_id"]), [*plain(r["text"] or ""), 0]) for r in awkward.collect())
    assert texts == want
    assert packing.pack(awkward.limit(0)).count() == 0


def test_partitions_exchange_what_is_not_full(spark):
    pieces = spark.range(4000).select(F.col("id").alias("uid"), (F.pmod(F.xxhash64("id"), F.lit(700)) + 1).alias("length")).coalesce(1)
    few = packing.place(pieces, capacity=1000, partition_pieces=100, rounds=4).join(pieces, "uid")
    alone = packing.place(pieces, capacity=1000, partition_pieces=100, rounds=1).join(pieces, "uid")
    lengths = np.array([r["length"] for r in pieces.collect()])
    n_few, n_alone = check_sequences(few.collect(), 1000), check_sequences(alone.collect(), 1000)
    assert few.count() == alone.count() == 4000
    assert packing.lower_bound(lengths, 1000) <= n_few < n_alone
    assert few.filter("certified").count() > 0
