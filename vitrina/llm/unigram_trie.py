"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A text is split at white space; each pre-token, with the word mark in front, gets the segmentation into
vocabulary pieces with the greatest sum of scores (Viterbi), and a character in no piece its UTF-8 bytes; of equal
sums the one whose last piece is longer. A worker keeps one trie for all its texts. A node stands for a prefix
and holds its forward score and its number of pieces, which are computed when the node is made and shared by all
pre-tokens that begin so; the node at a pre-token's end is marked as terminal and its number is the pre-token's count. New
pre-tokens are inserted in sorted order, so that a walk begins where it leaves the one before.

Scores. No public vocabulary here has unigram scores, and tokenisers are not trained; pieces take the
logarithm of a Zipf share by their rank in the vocabulary file.

No shuffle: a worker's trie is bounded and holds for all its tasks; when it is full it begins anew. Edge
cases: a null or empty text, or one of white space, has no tokens; very long texts and pre-tokens cost time in
proportion to their length; equal and repeated rows give a row each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from vitrina.llm import arrays as A
from vitrina.llm.tables import texts

MARK = "▁"
#: Nodes of a worker's trie.
NODES = 1_000_000
_CODES = 0x110000


def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file and the logarithm of their Zipf share by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1.0 / r for r in range(1, len(plain) + 1)))
    return {model.id_to_piece(i): -math.log(r) - total for r, i in enumerate(plain, 1)}


class Counter:
    """Counts of the best segmentations of pre-tokens under piece scores."""

    def __init__(self, scores: dict[str, float], nodes: int = NODES):
        self.scores, self.nodes = scores, nodes
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.clear()

    def clear(self) -> None:
        """An empty trie: children by parent and character, score and number of pieces by node, and terminal nodes."""
        self.children: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, words: set[str]) -> None:
        """Adds pre-tokens; only nodes that are new are computed."""
        children, scores, longest, unknown = self.children, self.scores, self.longest, self.unknown
        best, tokens = self.best, self.tokens
        path, before = [0], ""
        for word in sorted(words):
            marked = MARK + word
            shared, limit = 0, min(len(before), len(marked))
            while shared < limit and before[shared] == marked[shared]:
                shared += 1
            del path[shared + 1 :]
            node = path[shared]
            for end in range(shared + 1, len(marked) + 1):
                key = node * _CODES + ord(marked[end - 1])
                node = children.get(key, 0)
                if not node:
                    top, n = -math.inf, 0
                    for start in range(end - longest if end > longest else 0, end):
                        score = scores.get(marked[start:end])
                        if score is not None and best[path[start]] + score > top:
                            top, n = best[path[start]] + score, tokens[path[start]] + 1
                    if marked[end - 1] not in scores and best[path[end - 1]] + unknown > top:
                        top, n = best[path[end - 1]] + unknown, tokens[path[end - 1]] + len(marked[end - 1].encode("utf-8", "surrogatepass"))
                    node = children[key] = len(best)
                    best.append(top)
                    tokens.append(n)
                path.append(node)
            before = marked
            self.terminal[word] = node

    def count(self, word: str) -> int:
        """The count at a pre-token's terminal node."""
        return self.tokens[self.terminal[word]]

    def texts(self, rows: list[str]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        if len(self.best) > self.nodes:
            self.clear()
        split = [x.split() for x in rows]
        self.insert(set().union(*split).difference(self.terminal) if split else set())
        at, tokens = self.terminal.__getitem__, self.tokens.__getitem__
        return [len(x) for x in split], [sum(map(tokens, map(at, x))) for x in split]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(piece_scores(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words (pre-tokens), n_tokens and n_chars of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(path)
        for batch in A.slices(batches, limit=4 << 20):
            rows = batch.column("text").to_pylist()
            n_words, n_tokens = held.texts(rows)
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()), "n_chars": pa.array([len(x) for x in rows], pa.int64())})

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_chars long")
