"""Greedy word-piece lengths by a linear longest-match automaton.

A trie of the vocabulary gets, for each node, a failure link and the number of pieces popped when
it is taken, so a word is read once, character by character, and its number of pieces comes out
without building a piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from cotag.llm.common import WordTable, small_batches, texts_of
from cotag.llm.pieces import NORMAL, SPACE

COUNTS = "doc_id long, n_words long, n_tokens long, n_unknown_words long"


def word_pieces(model: bytes) -> tuple[str, ...]:
    """The pieces of a vocabulary file: those of word starts begin with the space mark."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    return tuple(p.piece for p in proto.pieces if p.type == NORMAL)


class LongestMatch:
    """Number of pieces that greedy longest match gives for a word.

    ``root`` is node 0. A node that is a piece fails to the root and pops that one piece. Any
    other node fails to where its parent's failure path can go on with the same character, and
    pops what that path pops; -1 means that no such path exists.
    """

    def __init__(self, pieces: Iterable[str]):
        self.step: list[dict[str, int]] = [{}]
        ends: list[bool] = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                after = self.step[node].get(c)
                if after is None:
                    after = len(self.step)
                    self.step[node][c] = after
                    self.step.append({})
                    ends.append(False)
                node = after
            if node:
                ends[node] = True
        self.fail = [-1] * len(self.step)
        self.popped = [0] * len(self.step)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in self.step[parent].items():
                queue.append(node)
                if ends[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                count, at = self.popped[parent], self.fail[parent]
                while at >= 0 and c not in self.step[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.step[at][c], count

    def count(self, word: str) -> int:
        """Pieces of ``word``, 0 if greedy longest match cannot spell it."""
        step, fail, popped = self.step, self.fail, self.popped
        node = total = 0
        for c in word:
            while (after := step[node].get(c)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = after
        while node:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return total


@lru_cache(maxsize=2)
def _automaton(pieces: tuple[str, ...]) -> tuple[LongestMatch, WordTable]:
    matcher = LongestMatch(pieces)
    return matcher, WordTable(lambda word: matcher.count(SPACE + word))


def count_tokens(docs: DataFrame, pieces: tuple[str, ...]) -> DataFrame:
    """Word-piece lengths of whole texts: (doc_id, n_words, n_tokens, n_unknown_words).

    Words are the parts between white space; a word starts with a piece that begins with the space
    mark and goes on with others, always the longest. A word that cannot be spelt so is one
    unknown token. A missing or empty text has no words. One row per input row; no shuffle; other
    columns are not read. ``pieces`` is a vocabulary, whose size does not grow with the data.
    """

    def run(batches):
        known = _automaton(pieces)[1]
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in texts_of(batch):
                counts = list(map(known.__getitem__, text.split()))
                none = counts.count(0)
                words.append(len(counts))
                tokens.append(sum(counts) + none)
                unknown.append(none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                names=[part.split()[0] for part in COUNTS.split(", ")],
            )

    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, COUNTS)
