"""Token files: exact round trips, digests, damage."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from safetylake.llm import packing, rans, token_files
from safetylake.session import new_path

EXACT = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def table_for(ids, bits=12):
    return rans.Table.from_bytes(rans.table_of(*np.unique(ids, return_counts=True), bits).to_bytes())


@given(st.lists(st.integers(0, 40), max_size=400), st.integers(1, 9), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_coder_round_trip(ids, lanes, every):
    ids = np.array(ids, dtype=np.int64)
    table = table_for(ids, 8)
    words, marks = rans.encode(ids, table, lanes, every)
    parts = list(rans.decode_all(words, marks, len(ids), lanes * every, table))
    assert len(parts) == len(marks) == -(-len(ids) // (lanes * every))
    assert np.concatenate([[], *parts]).tolist() == ids.tolist()


def test_coder_comes_near_the_entropy():
    ids = np.random.default_rng(1).zipf(1.4, 200_000) % 5000
    table = table_for(ids, 18)
    words, _ = rans.encode(ids, table, 64, 1 << 20)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert 4 * len(words) < -(share * np.log2(share)).sum() * len(ids) / 8 * 1.01


def test_every_checkpoint_decodes_alone():
    ids = np.random.default_rng(2).integers(0, 300, 10_000)
    table = table_for(ids)
    words, marks = rans.encode(ids, table, 16, 50)
    for i, (place, states) in enumerate(marks):
        part, _, _ = rans.decode(words[place:], states, min(800, len(ids) - 800 * i), table)
        assert part.tolist() == ids[800 * i : 800 * (i + 1)].tolist()


def test_damage_is_found():
    ids = np.arange(1000) % 7
    table = table_for(ids)
    block = token_files.pack_block([(5, 1000, 0, ids)], table, 77)
    (found,) = token_files.unpack_block(block, table, 77)
    assert found[:3] == (5, 1000, 0) and found[3].tolist() == ids.tolist()
    for at in (0, 10, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(token_files.unpack_block(bytes(broken), table, 77))
    with pytest.raises(ValueError):
        list(token_files.unpack_block(block, table, 78))


def test_crc_of_parts():
    data = bytes(range(256)) * 40
    for cut in (0, 1, 4, 4000, len(data)):
        whole = token_files.crc_before(zlib.crc32(data[:cut]), len(data) - cut) ^ zlib.crc32(data[cut:])
        assert whole == zlib.crc32(data)


def plain(rows):
    """(doc_id, n_tokens, crc) in the order of the files, ties in any order."""
    out = []
    for doc_id, text in rows:
        ids = [*EXACT.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check(found, rows):
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    at = 0
    for start, _, n, _ in found:
        assert start == at
        at += n
    ids = [f[1] for f in found]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))
    assert sorted([f[1:] for f in found], key=str) == sorted(plain(rows), key=str)


def test_whole_table(small):
    check(token_files.op13_token_files(small).collect(), small.select("doc_id", "text").collect())


def test_odd_rows(odd, none):
    check(token_files.op13_token_files(odd).collect(), odd.select("doc_id", "text").collect())
    assert token_files.op13_token_files(none).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_documents_go_on_in_the_next_block(spark, block):
    rows = [(3, "one two three four five " * 30), (1, "<|endoftext|> a"), (1, ""), (None, None), (2, "x" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = new_path(spark, "files")
    token_files.write_tokens(docs, path, block=block, lanes=4, span=8)
    check(token_files.digests(spark, path).collect(), rows)
    pieces = {}
    for r in token_files.read_tokens(spark, path).collect():
        pieces.setdefault((r.doc_id, r.start), []).append((r.offset, np.frombuffer(r.ids, "<u4").tolist()))
    texts = {(d, tuple(i for _, part in sorted(p) for i in part)) for (d, _), p in pieces.items()}
    assert texts == {(d, (*EXACT.encode(t or "", add_special_tokens=False).ids, 2)) for d, t in rows}
