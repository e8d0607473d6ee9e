import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from cabstand.llm import packing
from cabstand.llm.queries import byte_bpe
from tests.llm.support import clashing, odd_rows, table


def expected(rows, capacity):
    tokenizer = Tokenizer.from_file(byte_bpe()[1])
    out = []
    for row in rows:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for piece, (start, length) in enumerate(packing.piece_bounds(len(ids), capacity)):
            out.append((row[0], piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    return sorted(out, key=repr)


def check(spark, rows, capacity, block=65_536):
    pieces = packing.token_pieces(clashing(table(spark, rows)), *byte_bpe(), capacity)
    packed = packing.pack(pieces, capacity, block).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=repr) == expected(rows, capacity)
    held = defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(r.length for r in packed)


def test_added_tokens_in_a_text(spark):
    tokenizer = Tokenizer.from_file(byte_bpe()[1])
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    assert added
    rows = [(i, f"a {token} b{token}{token}\n<|other|>", "en", "a", 1) for i, token in enumerate(added)] + [(90, added[0], "en", "a", 1)]
    check(spark, rows, 1024)
    assert len(tokenizer.encode(added[0], add_special_tokens=False).ids) == 1


def test_round_trip(spark):
    sequences, tokens = check(spark, odd_rows(), 1024)
    assert sequences - 1 <= -(-tokens // 1024) + 1


def test_blocks_and_white_space_beyond_the_matcher(spark):
    rows = [*odd_rows(), (20, " " * 400_000, "en", "a", 1), (21, "<|endoftext|> 😀 ' '", "en", "a", 1)]
    check(spark, rows, 64, block=50)


def test_search_beats_the_start():
    rng = np.random.default_rng(1)
    lengths = rng.integers(300, 420, 2000)
    start, end = packing.best_fit(lengths, 1024), packing.packed_bins(lengths, 1024)
    assert len(end) < len(start)
    assert sorted(i for b in end for i in b) == list(range(2000))
    assert max(int(lengths[b].sum()) for b in end) <= 1024


def test_squared_fill_only_grows():
    rng = np.random.default_rng(2)
    lengths = rng.integers(100, 700, 300).tolist()
    search = packing.Search([[i] for i in range(300)], lengths, 1024)
    for bin_ in range(300):
        search.enter(bin_)
    before = sum(f * f for f in search.fill)
    for donor in range(300):
        search.leave(donor)
        while search.bins[donor] and search.step(donor):
            after = sum(f * f for f in search.fill)
            assert after > before
            before = after
        search.enter(donor)


def test_empty(spark):
    assert packing.pack(packing.token_pieces(table(spark, []), *byte_bpe())).count() == 0
