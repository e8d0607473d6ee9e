"""Token counts under a unigram vocabulary, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word with a word mark in front. Its best segmentation is the one whose pieces have the highest sum of log
probabilities; of equal sums, the one with the fewest pieces. Forward scores depend on a prefix alone, so the distinct pre-tokens of
a task are walked as a trie, in sorted order, and each prefix is scored once for all words that begin with it; the end of a
word stores its count. Words met before in the task are looked up; the table of counts is emptied once it holds ``memory``
words, which costs time and changes nothing. No row leaves its task: nothing is shuffled.

The vocabulary is a list of pieces in the order of their merges. Their probabilities follow Zipf's law for that
order. A character that no piece covers costs one token for each of its bytes.

Nulls and ties: NULL and empty texts have no pre-tokens and no tokens; rows that repeat are counted alike; other columns
pass through, except that the two counts replace older columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstand.llm.common import WORD

MARK = "▁"
#: Log probability of a byte that stands for an uncovered character: below that of any piece.
BYTE_SCORE = -25.0


class Vocabulary:
    """Pieces with log probabilities, as a trie of nested dictionaries read from the end of a piece."""

    END = ""

    def __init__(self, pieces: Iterable[str]):
        ranked = list(dict.fromkeys(p for p in pieces if p))
        norm = math.log(sum(1.0 / rank for rank in range(2, len(ranked) + 2)))
        self.scores = {piece: -math.log(rank) - norm for rank, piece in enumerate(ranked, 2)}
        self.reversed: dict = {}
        for piece, score in self.scores.items():
            node = self.reversed
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[self.END] = score

    def extend(self, word: str, end: int, best: list[tuple[float, int]]) -> tuple[float, int]:
        """(score, -tokens) of the prefix of length ``end``, given those of all shorter prefixes."""
        node, start = self.reversed, end
        found = None
        while start:
            node = node.get(word[start - 1])
            if node is None:
                break
            start -= 1
            score = node.get(self.END)
            if score is not None:
                candidate = (best[start][0] + score, best[start][1] - 1)
                if found is None or candidate > found:
                    found = candidate
        if word[end - 1] not in self.scores:
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            spelled = (best[end - 1][0] + size * BYTE_SCORE, best[end - 1][1] - size)
            if found is None or spelled > found:
                found = spelled
        return found

    def counts(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """(word, tokens) for distinct words: a walk through their trie that keeps the scores of the present path."""
        best, before = [(0.0, 0)], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best.append(self.extend(word, end, best))
            before = word
            yield word, -best[-1][1]


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    """The normal pieces of a sentencepiece model, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return Vocabulary(model.id_to_piece(i) for i in range(model.vocab_size()) if not special(i))


def token_counts(docs: DataFrame, model: str, text: str = "text", memory: int = 500_000) -> DataFrame:
    """``docs`` without its text, with ``n_pretokens`` and ``n_tokens``."""
    kept = [name for name in docs.columns if name not in (text, "n_pretokens", "n_tokens")]
    schema = T.StructType(
        [docs.schema[name] for name in kept] + [T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = load_vocabulary(model), {}
        for batch in batches:
            pretokens, tokens = [], []
            # A few hundred texts at a time bound the word lists, however large a batch is.
            for at in range(0, batch.num_rows, 256):
                lists = [WORD.findall(t.as_py() or "") for t in batch.column(batch.num_columns - 1).slice(at, 256)]
                fresh = {w for words in lists for w in words if w not in known}
                if len(known) + len(fresh) > memory:
                    known = {}
                    fresh = {w for words in lists for w in words}
                known.update((w[len(MARK) :], n) for w, n in vocabulary.counts(MARK + w for w in fresh))
                pretokens += map(len, lists)
                tokens += [sum(map(known.__getitem__, words)) for words in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pretokens, pa.int64()), pa.array(tokens, pa.int64())],
                [*kept, "n_pretokens", "n_tokens"],
            )

    columns = [F.col(f"`{name}`") for name in kept]
    return docs.select(*columns, F.col(text).cast("string").alias("_text")).mapInArrow(count, schema)
