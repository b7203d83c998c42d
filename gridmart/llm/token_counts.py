"""Token counts by a trie-shared unigram dynamic program.

A vocabulary of byte strings with log-probabilities is a unigram model; the
tokenisation of a pre-token is its most probable segmentation, of equal ones
that with fewer tokens. The best score and token count of a prefix depend on the prefix alone, so
distinct pre-tokens are inserted into a trie and each node computes its forward
score once, from its ancestors' scores. A pre-token's end node keeps the count.

Each task grows its own trie over the documents it reads; when it has
``max_nodes`` nodes it starts anew before the next new word, so its size is bounded by that and
the bytes of the longest pre-token, and no dictionary is shuffled or shared.

The vocabulary file holds ranks, no probabilities: a token's probability is
taken as proportional to 1 / (rank + 2) (Zipf's law over the ranks).

Edge cases: a null or empty text has no tokens; repeated rows count alike; extra
columns are ignored; an empty table gives no rows; a pre-token of any length is
segmented whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from math import log

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Nodes of one task's trie (about 150 bytes each).
MAX_NODES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in f if x.strip())}


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = sum(1 / (r + 2) for r in ranks.values())
    return {token: -log((r + 2) * total) for token, r in ranks.items()}


class ScoreTrie(dict):
    """Pre-token -> number of tokens, computed on first use.

    ``children`` maps (parent node, byte) to a node; a node holds the best
    score of its prefix and the tokens of that segmentation.
    """

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES) -> None:
        super().__init__()
        self.scores, self.max_nodes = scores, max_nodes
        self.longest = max(map(len, scores), default=1)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.children: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]

    def __missing__(self, word: str) -> int:
        if len(self.best) > self.max_nodes:
            self.reset()
        n = self[word] = self.insert(word.encode("utf-8", "surrogatepass"))
        return n

    def insert(self, data: bytes) -> int:
        """Walk the trie along ``data``, computing the nodes that are missing."""
        children, best, tokens, scores = self.children, self.best, self.tokens, self.scores
        path, node = [0], 0
        for end, byte in enumerate(data, 1):
            key = node << 8 | byte
            node = children.get(key)
            if node is None:
                top, fewest = None, 0
                for start in range(max(0, end - self.longest), end):
                    s = scores.get(data[start:end])
                    if s is not None and best[path[start]] is not None:
                        total, n = best[path[start]] + s, tokens[path[start]] + 1
                        if top is None or total > top or (total == top and n < fewest):
                            top, fewest = total, n
                node = children[key] = len(best)
                best.append(top)
                tokens.append(fewest)
            path.append(node)
        if best[node] is None:
            raise ValueError("the vocabulary lacks some single byte")
        return tokens[node]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row; ``vocabulary`` is a rank file's path."""
    scores = zipf_scores(read_ranks(vocabulary))
    sent = docs.sparkSession.sparkContext.broadcast(scores)  # the vocabulary file, of fixed size
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType),
                           T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ScoreTrie(sent.value, max_nodes)
        split = regex.compile(pattern)
        for b in batches:
            pre, total = [], []
            for t in b.column(1):
                found = split.findall(t.as_py() or "")
                pre.append(len(found))
                total.append(sum(map(trie.__getitem__, found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pre, pa.int64()), pa.array(total, pa.int64())], names=schema.names)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
