import random

import public_tokenizers

from cabstand.llm import counts
from cabstand.llm.common import WORD
from tests.llm.support import clashing, odd_rows, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(vocabulary, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[s][0] + vocabulary.scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in vocabulary.scores
        ]
        if word[end - 1] not in vocabulary.scores:
            size = len(word[end - 1].encode())
            options.append((best[end - 1][0] + size * counts.BYTE_SCORE, best[end - 1][1] - size))
        best.append(max(options))
    return -best[-1][1]


def test_trie_against_single_words():
    vocabulary, rng = counts.load_vocabulary(MODEL), random.Random(8)
    words = {"".join(rng.choice("abcdeé😀語tion") for _ in range(rng.randint(1, 14))) for _ in range(400)}
    marked = {counts.MARK + w for w in words}
    assert dict(vocabulary.counts(marked)) == {w: brute(vocabulary, w) for w in marked}


def test_odd_rows_in_a_small_memory(spark):
    vocabulary = counts.load_vocabulary(MODEL)
    for memory in (10, 500_000):
        got = counts.token_counts(clashing(table(spark)), MODEL, memory=memory)
        assert "text" not in got.columns
        want = []
        for r in odd_rows():
            words = WORD.findall(r[1] or "")
            want.append((r[0], len(words), sum(brute(vocabulary, counts.MARK + w) for w in words)))
        assert sorted(((r.doc_id, r.n_pretokens, r.n_tokens) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_empty(spark):
    assert counts.token_counts(table(spark, []), MODEL).count() == 0
