"""Token counts by a unigram segmentation, with forward scores shared along a trie of pre-tokens.

Pre-tokens are the texts' parts between spaces (all but the first with the space before them), as UTF-8 bytes. A token's score
is the log of a Zipf prior by its rank in a public vocabulary of bytes; the best segmentation of a pre-token maximises the sum
(ties: fewer tokens). Its forward scores (best score and tokens of each prefix) are kept at the trie's nodes, so a prefix that
several pre-tokens share is computed once, and each pre-token's count is read at its last node. A worker keeps its trie between
tasks, up to NODES nodes, then starts a new one; single bytes are all tokens, so every text can be segmented.

A null text has no pre-tokens and 0 tokens; an empty one too. A null id stays null. Repeated rows are rows of their own. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import workers
from kinweave.llm.tokens import Encoder

NODES = 1_000_000
_TRIES: dict[str, "Trie"] = {}
workers.keeps("counts", _TRIES.clear)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Trie:
    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        whole = sum(1 / (r + 1) for r in ranks.values())
        self.score = {t: -log((r + 1) * whole) for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]
        self.known: dict[str, int] = {}

    def _insert(self, word: bytes) -> int:
        """Walks down, makes the nodes that are missing, and returns the count at the last one."""
        path, node = [0], 0
        edges, best, tokens, score = self.edges, self.best, self.tokens, self.score
        for i, byte in enumerate(word, 1):
            key = node << 8 | byte
            child = edges.get(key)
            if child is None:
                top, fewest = -1e300, 0
                for start in range(max(0, i - self.longest), i):
                    s = score.get(word[start:i])
                    if s is not None:
                        at = path[start]
                        s += best[at]
                        n = tokens[at] + 1
                        if s > top or s == top and n < fewest:
                            top, fewest = s, n
                child = edges[key] = len(best)
                best.append(top)
                tokens.append(fewest)
            node = child
            path.append(node)
        return tokens[node]

    def count(self, text: str) -> tuple[int, int]:
        """Pre-tokens and tokens."""
        if not text:
            return 0, 0
        first, *rest = Encoder.cut(text)
        if len(self.best) > NODES:
            self.clear()
        known = self.known
        for w in set(rest).difference(known):
            known[w] = self._insert(b" " + w.encode("utf-8", "surrogatepass"))
        head = self._insert(first.encode("utf-8", "surrogatepass"))
        return len(rest) + bool(first), head + sum(map(known.__getitem__, rest))


def trie(vocabulary: str) -> Trie:
    workers.serve("counts")
    if vocabulary not in _TRIES:
        _TRIES[vocabulary] = Trie(vocabulary)
    return _TRIES[vocabulary]


def count(docs: DataFrame, vocabulary: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every row, in one pass and without a shuffle."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trie(vocabulary)
        for b in batches:
            found = [own.count(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
