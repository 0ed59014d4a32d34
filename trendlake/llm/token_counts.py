"""Counts of greedy longest-match pieces without building the pieces.

A trie over the vocabulary gets failure links: from the node of a string, the link leads to what is left after
the longest pieces at its front are taken off, and the node stores how many those are. Reading a word moves along
edges, and along failure links where no edge fits, adding the stored counts; so the time is linear in the word, and no piece
is ever built. Another stored count per node ends the word. Words are counted once per batch and remembered.

Defined cases: a null or empty text has no words and no pieces. A word that the vocabulary can't spell counts as one
piece (with single bytes in the vocabulary there is none). Equal rows get equal counts. Extra columns aren't read.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from trendlake.llm.common import slices, small_batches

NOWHERE = -1


class Automaton:
    """Edges by ``node << 8 | byte``, failure link, pieces taken on failure and pieces at a word's end, by node."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.edges: dict[int, int] = {}
        parent, label, whole = [NOWHERE], [0], [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                step = node << 8 | byte
                if step not in self.edges:
                    self.edges[step] = len(parent)
                    parent.append(node), label.append(byte), whole.append(False)
                node = self.edges[step]
            whole[node] = bool(piece)
        children: dict[int, list[int]] = {}
        for node in range(1, len(parent)):
            children.setdefault(parent[node], []).append(node)
        self.fail, self.popped, self.at_end = [NOWHERE] * len(parent), [0] * len(parent), [0] * len(parent)
        waiting = deque(children.get(0, []))
        while waiting:
            node = waiting.popleft()
            waiting.extend(children.get(node, []))
            if whole[node]:
                self.fail[node], self.popped[node] = 0, 1
            else:
                back, taken = self.fail[parent[node]], self.popped[parent[node]]
                while back != NOWHERE and back << 8 | label[node] not in self.edges:
                    taken += self.popped[back]
                    back = self.fail[back]
                if back != NOWHERE:
                    self.fail[node], self.popped[node] = self.edges[back << 8 | label[node]], taken
            # Failure links lead to shorter strings, which are done.
            back = self.fail[node]
            self.at_end[node] = NOWHERE if back == NOWHERE or self.at_end[back] == NOWHERE else self.popped[node] + self.at_end[back]

    def count(self, word: bytes) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for byte in word:
            while (step := node << 8 | byte) not in edges:
                total += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return 1
            node = edges[step]
        return 1 if self.at_end[node] == NOWHERE else total + self.at_end[node]


def ranked_vocabulary(path: str) -> list[bytes]:
    """The byte strings of a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def token_counts(docs: DataFrame, vocabulary: list[bytes], prefix: bytes = b" ", limit: int = 400_000) -> DataFrame:
    """doc_id, n_words, n_tokens; words lie between ASCII blanks and are read with ``prefix`` in front.

    The automaton is built on the driver and sent with the function: its size is the vocabulary's. A worker remembers
    ``limit`` words at most, then forgets them together.
    """
    automaton = Automaton(vocabulary)
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, known = automaton.count, {}
        for whole in batches:
            for batch in slices(whole, 1):
                words = pc.ascii_split_whitespace(pc.fill_null(batch.column(1), ""))
                coded = words.flatten().dictionary_encode()
                if len(known) > limit:
                    known.clear()
                table = []
                for word in coded.dictionary.cast(pa.binary()).to_pylist():
                    if word not in known:
                        known[word] = count(prefix + word) if word else 0
                    table.append(known[word])
                size = np.array(table, np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if table else np.zeros(0, np.int64)
                edges = words.offsets.to_numpy() - words.offsets[0].as_py()
                tokens = np.diff(np.concatenate([[0], np.cumsum(size)])[edges])
                filled = np.diff(np.concatenate([[0], np.cumsum(size > 0)])[edges])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(filled, pa.int64()), pa.array(tokens, pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    schema = source.drop("text").schema.add("n_words", "long").add("n_tokens", "long")
    return source.mapInArrow(run, schema)
