"""Unigram token counts against a plain Viterbi run per word."""

import public_tokenizers as P
import pytest
import regex

from gridmart.llm import token_counts as C

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def scores():
    return C.zipf_scores(C.read_ranks(PATH))


def viterbi(data, scores):
    best = [(0.0, 0)] + [None] * len(data)
    for end in range(1, len(data) + 1):
        for start in range(end):
            s = scores.get(data[start:end])
            if s is not None:
                c = (best[start][0] + s, best[start][1] + 1)
                if best[end] is None or c[0] > best[end][0] or (c[0] == best[end][0] and c[1] < best[end][1]):
                    best[end] = c
    return best[-1][1]


def test_counts_match_brute_force_on_a_table(spark, scores):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    memo = {}

    def plain(text):
        ws = regex.findall(P.PATTERN, text or "")
        for w in set(ws) - set(memo):
            memo[w] = viterbi(w.encode(), scores)
        return len(ws), sum(memo[w] for w in ws)

    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in C.count_tokens(docs, PATH, P.PATTERN).collect()}
    assert got == want


def test_prefix_scores_are_shared_and_memory_is_bounded(scores):
    trie = C.ScoreTrie(scores)
    trie["internationalisation"]
    nodes = len(trie.best)
    trie["international"], trie["inter"]
    assert len(trie.best) == nodes  # both end on nodes of the first
    trie["internationally"]
    assert len(trie.best) == nodes + 2
    small = C.ScoreTrie(scores, max_nodes=30)
    words = [f"word{i}x{i * 7}" for i in range(200)]
    assert [small[w] for w in words] == [viterbi(w.encode(), scores) for w in words]
    assert len(small.best) < 60


def test_edge_rows(spark, scores):
    rows = [(1, None), (2, ""), (3, "a" * 3000), (None, "É ü 漢字"), (5, " \n\n x"), (5, " \n\n x")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_tokens int")
    got = [(r.doc_id, r.n_tokens) for r in C.count_tokens(df, PATH, P.PATTERN).collect()]
    want = [(d, sum(viterbi(w.encode(), scores) for w in regex.findall(P.PATTERN, t or ""))) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert C.count_tokens(df.limit(0), PATH, P.PATTERN).collect() == []
