"""Greedy longest-match piece counts with a linear automaton.

The vocabulary is a trie with failure links: where the next byte has no edge, the automaton pops the pieces that greedy
matching would emit and goes on at the failure state, so every byte is read once. Each state stores only how many
pieces its failure pops, so a word's length in pieces is found without building one.

Pieces follow the word-piece convention: a vocabulary entry that starts with a space begins a word, the others go on
with it. A word is a run of letters, digits and underscores, or one other character that is not white space. A word
that cannot be matched to its end counts as one unknown piece.

Defined results: null, empty and blank texts count no word and no piece; a null ``doc_id`` is kept; repeated rows give
repeated rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.byte_bpe import read_ranks
from ledgerline.llm.common import Memo, pieces

WORD = re.compile(r"\w+|[^\w\s]")
START, INSIDE, NOWHERE = 0, 1, -1
COUNTED = "doc_id long, n_words long, n_tokens long, n_unknown long"


class Automaton:
    """States 0 and 1 are the roots of word-starting and of continuing pieces."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.edge: dict[int, int] = {}
        self.final = [False, False]
        for token in vocabulary:
            starts = token[:1] == b" "
            body = token[1:] if starts else token
            if body:
                self._insert(START if starts else INSIDE, body)
        self._link()

    def _insert(self, state: int, body: bytes) -> None:
        for byte in body:
            key = state << 8 | byte
            if key not in self.edge:
                self.edge[key] = len(self.final)
                self.final.append(False)
            state = self.edge[key]
        self.final[state] = True

    def _link(self) -> None:
        """``fail[s]``: where matching goes on after popping ``popped[s]`` pieces from state ``s``."""
        n = len(self.final)
        children: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for key, child in self.edge.items():
            children[key >> 8].append((key & 255, child))
        self.fail, self.popped = [NOWHERE] * n, [0] * n
        queue = deque([START, INSIDE])
        while queue:
            state = queue.popleft()
            for byte, child in children[state]:
                if self.final[child]:
                    self.fail[child], self.popped[child] = INSIDE, 1
                else:
                    at, count = self.fail[state], self.popped[state]
                    while at != NOWHERE and (step := self.edge.get(at << 8 | byte)) is None:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at != NOWHERE:
                        self.fail[child], self.popped[child] = step, count
                queue.append(child)

    def count(self, word: bytes) -> int:
        """Pieces of one word; 0 if it cannot be matched to its end."""
        edge, fail, popped = self.edge, self.fail, self.popped
        state, total = START, 0
        for byte in word:
            while (step := edge.get(state << 8 | byte)) is None:
                if fail[state] == NOWHERE:
                    return 0
                total += popped[state]
                state = fail[state]
            state = step
        while state != INSIDE:
            if fail[state] == NOWHERE:
                return 0
            total += popped[state]
            state = fail[state]
        return total


_AUTOMATA: dict[int, tuple[Automaton, Memo]] = {}  # one per worker process


def share_vocabulary(spark: SparkSession, path: str):
    """Broadcast of the vocabulary's entries; bounded by the vocabulary file."""
    return spark.sparkContext.broadcast(list(read_ranks(path)))


def count_tokens(docs: DataFrame, vocabulary) -> DataFrame:
    """Words, pieces and unknown words of every whole text."""

    def run(batches):
        key = id(vocabulary.value)
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            automaton = Automaton(vocabulary.value)
            _AUTOMATA[key] = automaton, Memo(lambda w: automaton.count(w.encode()), 500_000)
        memo = _AUTOMATA[key][1]
        for batch in pieces(batches, 1):
            rows = []
            for text in batch.column(1).to_pylist():
                counts = list(map(memo.__getitem__, WORD.findall(text))) if text else []
                unknown = counts.count(0)
                rows.append((len(counts), sum(counts) + unknown, unknown))
            numbers = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(numbers[:, k]) for k in range(3))], names=["doc_id", "n_words", "n_tokens", "n_unknown"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTED)
