"""Prefix BPE and token-id files against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from logtide.llm import bpe_dp, direct_codes
from logtide.llm.queries import END_ID, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts():
    rnd = random.Random(1)
    alphabet = "ab \n\t  eéß's't 12中文😀'LL'll.,!\x1c\x85\xa0\u2028\u3000\r\u200b\x00aaaa"
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    return out + ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "", " ", "a" * 500, "the the the.\nThe the, the", "x" * 5000,
                  "éé&&& a*** b$$$ c!? d'' e-- ñandú... (x) y, Ünder_score z;' ªb µ. ×a aa÷ ɏɐ"]


def test_encoder_equals_library(library):
    bpe, cutter = bpe_dp._coder(tokenizer_path())
    of = bpe_dp.token_bytes(tokenizer_path())
    found, bounds = cutter.encode(pa.array(texts()))
    assert len(bounds) == len(texts()) + 1 and bounds[-1] == len(found)
    for x, a, b in zip(texts(), bounds[:-1], bounds[1:], strict=True):
        ids = found[a:b].tolist()
        assert ids == library.encode(x, add_special_tokens=False).ids, x
        assert b"".join(of[i] for i in ids).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)
    rnd = random.Random(4)
    vocabulary = sorted(bpe.whole)
    for _ in range(3000):
        word = "".join(rnd.choice(vocabulary) for _ in range(3))
        assert bpe.encode_word(word) == library.model.tokenize(word) or bpe.encode_word(word) == [t.id for t in library.model.tokenize(word)]


def test_pieces_keep_two_generations(monkeypatch):
    from logtide.llm import bpe_pieces

    monkeypatch.setattr(bpe_pieces, "MOST", 10)
    calls = []
    pieces = bpe_pieces.Pieces(lambda xs: calls.extend(xs) or [x.encode() for x in xs])
    for i in list(range(25)) * 2:
        assert pieces.look_up([str(i), "often"]) == [str(i).encode(), b"often"]
        assert len(pieces.kept) <= 10 and len(pieces.older) <= 10
    assert calls.count("often") == 1
    assert pieces.look_up(["x" * 65] * 2) == [b"x" * 65] * 2 and "x" * 65 not in pieces.kept  # too long to be kept


def test_both_cutters_agree_on_blocks_of_mixed_texts(library):
    path = tokenizer_path()
    mixed = pa.array([None, "", "a b\nc d", "\nfirst", "last\n", " lead", "trail ", "two  spaces", "a<|endoftext|>b c", "\n", "ünï cödé. x1, y", "a&&& éé*** b's c!? ɏɐ ª, d.'x"])
    want = [library.encode(x or "", add_special_tokens=False).ids for x in mixed.to_pylist()]
    for cutter in (bpe_dp._coder(path)[1], direct_codes._cutter(path)):
        for block in (mixed, mixed.slice(3, 5), mixed.slice(0, 0)):
            ids, bounds = cutter.encode(block)
            at = block.offset
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want[at:at + len(block)]


def test_encode_and_decode_odd_rows(odd_docs, no_docs, library):
    path = tokenizer_path()
    got = bpe_dp.decode(bpe_dp.encode(odd_docs, path), path).collect()
    want = sorted((str(r.doc_id), tuple(library.encode(r.text or "", add_special_tokens=False).ids), r.text or "") for r in odd_docs.collect())
    assert sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in got) == want
    assert bpe_dp.decode(bpe_dp.encode(no_docs, path), path).count() == 0


def test_segment_gives_any_token():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 256, 3000), rng.integers(0, 60_000, 4000), rng.integers(0, 1 << 31, 600), [0, 255, 256, 65_535, 65_536]])
    rng.shuffle(ids)
    counts = [0, 5, 0, 2000, len(ids) - 2005, 0]
    seg = direct_codes.Segment(direct_codes.pack([9, 9, -1, 4, 5, 6], counts, ids.astype(np.uint32)))
    assert seg.n == len(ids) and seg.doc_ids.tolist() == [9, 9, -1, 4, 5, 6] and np.diff(seg.starts).tolist() == counts
    assert [seg.token(i) for i in range(0, seg.n, 7)] == ids[::7].tolist()
    for a, b in ((0, seg.n), (511, 513), (100, 100), (7, 4097), (seg.n - 1, seg.n)):
        assert seg.slice(a, b).tolist() == ids[a:b].tolist()
    empty = direct_codes.Segment(direct_codes.pack([], [], np.zeros(0, np.uint32)))
    assert empty.n == 0 and empty.slice(0, 0).tolist() == []


def test_files_hold_documents_in_order(spark, odd_docs, no_docs, library):
    path = tokenizer_path()
    files = direct_codes.write_ids(odd_docs, path, END_ID, segment_ids=500)
    rows = [r for r in odd_docs.collect() if r.doc_id is not None]
    got = sorted(direct_codes.read_ids(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows)
    at = 0
    whole = []
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == END_ID
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
        whole += r.ids
    want = sorted((r.doc_id, *library.encode(r.text or "", add_special_tokens=False).ids, END_ID) for r in rows)
    assert sorted((r.doc_id, *r.ids) for r in got) == want
    places = [0, 1, at // 2, at - 1, 499, 500, 501]
    found = direct_codes.tokens_at(files, spark.createDataFrame([(p,) for p in places], "place long"), block=300)
    assert {r.place: r.token for r in found.collect()} == {p: whole[p] for p in places}
    assert direct_codes.read_ids(direct_codes.write_ids(no_docs, path, END_ID)).count() == 0
