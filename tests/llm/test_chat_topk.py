import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapwright.llm import chat, topk

HOSTILE = st.lists(st.sampled_from(list("<>/s[]INTSYROLE|endoftx\\ \né🙂") + sorted(chat.CONTROLS)), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(HOSTILE)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]"]), HOSTILE)
def test_turn_round_trip(role, text):
    codec = chat.codec(chat.default_ranks())
    ids, mask = chat.assemble(role, text, codec.encode_ordinary)
    decode = lambda i: codec.decode_bytes(i).decode()
    got = chat.read_turn(ids, mask, decode)
    assert got[:3] == (role, text, text if role == "assistant" else "")
    # A text of control strings gives no reserved id but those of the frame.
    assert (ids >= chat.FIRST_RESERVED).sum() == len(chat.assemble(role, "", codec.encode_ordinary)[0]) - (len(codec.encode_ordinary(chat.escape(role))) if role not in ("user", "assistant", "system") else 0)


def test_conversations_round_trip(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", None), (1, 3, "assistant", "c\\d</s>"), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (2, None, None, ""), (2, 0, "tool", "[INST]"), (3, 0, "assistant", "y" * 300_000)]
    rows += [(9, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(500)]
    df = spark.createDataFrame([(*r, "x", b"") for r in rows], "conv_id long, turn long, role string, text string, tie string, ids binary").repartition(3)
    folder = f"file://{tmp_path}/chat"
    chat.write_formatted(df, folder)
    formatted = chat.read_formatted(spark, folder)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_turns(formatted)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss) and got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    at = 0
    for r in formatted.filter("conv_id = 9").orderBy("turn_no").collect():
        assert r["token_start"] == at and len(r["ids"]) == 4 * len(r["mask"])
        at += len(r["mask"])
    assert got[1]["formatted_chars"] == len("<s>[INST]a[/INST]b</s>[INST][/INST]c\\\\d<\\/s></s>")
    chat.write_formatted(df.limit(0), folder + "-none")
    assert chat.digests(chat.read_turns(chat.read_formatted(spark, folder + "-none"))).count() == 0


def brute(rows, k):
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in sound:
        if q % 2 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in sound if i != q))[:k]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("scale", [1.0, 1e4, 3e6])
def test_top_k_is_what_brute_force_finds(spark, scale):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, scale, 6) * (rng.random(6) < 0.5)]) for i in range(150)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, [1.0, None]), (204, [float("nan")] * 6), (206, [float("inf")] + [0.0] * 5), (208, []), (210, [1.0, -2.0]), (None, [1.0] * 6), (212, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, terms string, score int").repartition(4)
    for chunk, block in ((256, 16_384), (7, 11)):
        got = topk.exact_top_k(df, F.col("vec_id") % 2 == 0, k=5, chunk_rows=chunk, block_rows=block).collect()
        assert {tuple(r) for r in got} == brute(rows, 5) and len(got) == len(brute(rows, 5))
    few = topk.exact_top_k(df.limit(0), F.lit(True), k=5)
    assert few.count() == 0


def test_scattering_equals_products():
    rng = np.random.default_rng(2)
    asked, held = rng.integers(-9, 9, (13, 40)) * (rng.random((13, 40)) < 0.3), rng.integers(-9, 9, (50, 40)) * (rng.random((50, 40)) < 0.2)
    assert (topk.accumulate(asked, held) == asked @ held.T).all()
