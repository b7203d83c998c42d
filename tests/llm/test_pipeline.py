"""The pipeline's stages against plain re-computations of their decisions."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from gridmart.llm import byte_bpe, quality_cotraining as Q, simhash_dedup as S
from test_decontamination import brute as contaminated
from test_native_ops import plain_counts
from test_simhash_dedup import brute_links

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for k, (_, f) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp("p") / f"{k}")
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [[r.asDict() for r in d.collect()] for d in out]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_columns_pass_through(stages):
    for rows in stages[1:5]:
        assert rows and set(rows[0]) == {"doc_id", "text", "lang", "source", "n_chars"}
        by_id = {r["doc_id"]: r for r in stages[0]}
        assert all(by_id[r["doc_id"]] == r for r in rows)


def test_classifier_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(stages[1]))
    assert all(d in kept for d, q in labels.items() if q == 1)


def test_rules_match_brute_force(stages):
    def good(text):
        n, chars, symbols, lines, dup, repeat, upper, lower = plain_counts(text)
        return not (n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 10 * dup > 6 * lines
                    or chars < 2 * n or chars > 15 * n or upper > lower)

    assert ids(stages[2]) == sorted(r["doc_id"] for r in stages[1] if good(r["text"]))


def test_one_document_of_each_group_stays(stages):
    fp = {r["doc_id"]: S.fingerprint(r["text"]) for r in stages[2]}
    parent = {x: x for x in fp.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_links(fp.values()):
        parent[root(a)] = root(b)
    low = {}
    for d in sorted(fp):
        low.setdefault(root(fp[d]), d)
    assert ids(stages[3]) == sorted(low.values())


def test_repeated_rows_and_shared_ids_leave_one_per_group(spark):
    long, other = " ".join(f"w{i}" for i in range(300)), " ".join(f"v{i}" for i in range(300))
    rows = [(1, long), (1, long), (1, other), (2, long), (3, other), (None, None), (None, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int")
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=str) == sorted(
        df.dropDuplicates().where("doc_id = 1 OR doc_id IS NULL").collect(), key=str)


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in contaminated([(r["doc_id"], r["text"]) for r in stages[3]], items)}
    assert ids(stages[4]) == [d for d in ids(stages[3]) if d not in bad]


def test_ids_are_those_of_the_library(stages):
    v = byte_bpe.Vocabulary.read(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    text = {r["doc_id"]: r["text"] for r in stages[4]}
    assert ids(stages[5]) == ids(stages[4])
    for r in stages[5]:
        assert list(r["ids"]) == enc.encode_ordinary(text[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    assert ids([r.asDict() for r in C.run(spark, SF).collect()]) == ids(stages[5])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in C.STAGES[:4]:
        docs = f(spark, docs, SF)
        assert docs.collect() == []
    assert C.tokenize(spark, docs, SF).collect() == []
    assert Q.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")).text is None


def test_stages_take_nulls_repeats_long_texts_and_clashing_columns(spark, stages, tmp_path):
    kept = [r["text"] for r in sorted(stages[4], key=lambda r: r["doc_id"]) if r["n_chars"] > 800]
    good, long = kept[:6], "\n".join(kept)
    assert len(long) > 100_000
    rows = [(1, good[0], "en", "a"), (1, good[0], "en", "a"), (2, good[0] + " tail", None, None), (3, None, "en", "a"),
            (4, "", None, "a"), (None, good[1], "en", None), (5, good[2], "en", "a"), (6, long, "de", "b"), (7, good[3], "en", "a")]
    extra = "component string, fp int, ids string, y int, shard int, n_words string, score double"
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "c", 1, "i", 2, 3, "w", 0.5) for r in rows],
                               f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    docs = df
    for k, (_, f) in enumerate(C.STAGES[:4]):
        f(spark, docs, SF).write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        assert docs.columns == df.columns
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert left.count((1, good[0])) <= 1 and (3, None) not in left and (6, long) in left
    out = {r.doc_id: r for r in C.tokenize(spark, docs, SF).collect()}
    assert out[6].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
